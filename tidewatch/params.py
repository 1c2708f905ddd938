"""Parameters of the pipeline: what the columns mean and how drift is measured."""

from __future__ import annotations

from dataclasses import dataclass, field

# The 58 numeric model features, in contract order.
NUMERIC_FEATURES = (
    "nro_producto_6m", "prom_uso_tc_rccsf3m", "ctd_sms_received", "max_usotcribksf06m",
    "ctd_camptot06m", "dsv_svppallsf06m", "prm_svprmecs06m", "ctd_app_productos_m1",
    "ctd_campecsm01", "lin_tcrrstsf03m", "mnt_ptm", "dif_no_gestionado_4meses",
    "max_campecs06m", "beta_pctusotcr12m", "rat_disefepnm01", "flg_saltotppe12m",
    "prom_sow_lintcribksf3m", "openhtml_1m", "nprod_1m", "nro_transfer_6m",
    "max_usotcrrstsf03m", "prm_cnt_fee_amt_u7d", "pas_avg6m_max12m", "beta_saltotppe12m",
    "seg_un", "ant_ultprdallsf", "avg_sald_pas_3m", "pas_1m_avg3m", "num_incrsaldispefe06m",
    "cnl_age_p4m_p12m", "cnl_atm_p4m_p12m", "cre_lin_tc_rccibk_m07", "prm_svprmlibdis06m",
    "ingreso_neto", "max_nact_12m", "cre_sldtotfinprm03", "dif_contacto_efectivo_10meses",
    "act_1m_avg3m", "monto_consumos_ecommerce_tc", "ctd_camptotm01", "prop_atm_4m",
    "prom_pct_saldopprcc6m", "apppag_1m", "nro_configuracion_6m", "act_avg6m_max12m",
    "sldvig_tcrsrcf", "prom_score_acepta_12meses", "telefonos_6meses", "pas_1m_avg6m",
    "ctd_camptototrcnl06m", "prm_saltotrdpj03m", "bpitrx_1m", "prm_lintcribksf03m",
    "ctd_entrdm01", "avg_openhtml_6m", "tea", "pct_usotcrm01", "senthtml_1m",
)

# Texts read as missing, the numeric filler, and the two category labels.
MISSING_TOKENS = ("", "null", "None")
NUMERIC_SENTINEL = -9999999.0
MISSING_CATEGORY = "SV"
OTHER_CATEGORY = "OTRO"

# Upper ends, in thousandths, of the ten execution groups (10 = lowest scores).
GROUP_CUTS_PER_MILLE = (0, 35, 87, 237, 393, 529, 664, 787, 862, 950, 1000)

# Campaign group -> freshness weight, and the weight of everything else.
FRESHNESS_WEIGHTS = {"G1": 0.066, "G2": 0.028, "G3": 0.022, "G4": 0.008}
FRESHNESS_OTHER = 0.004
CONTACT_PROBABILITY_FILL = 0.000001

# Constant columns of the delivery table.
DOCUMENT_TYPE = "1"
DELIVERY_MODEL_LABEL = "EC OMNICANAL"
CUSTOMER_ID_WIDTH = 10

# An empty bin counts as this share.
EMPTY_SHARE = 1e-6


@dataclass(frozen=True)
class FeatureSpec:
    """Names and cleaning rules of one model's columns."""

    numeric: tuple[str, ...] = NUMERIC_FEATURES
    # Fixed values of the reference data: the category column and the value it keeps.
    category: str = "ent_1erlntcrallsfm01"
    allowed: tuple[str, ...] = ("INTERBANK",)
    missing_category: str = MISSING_CATEGORY
    other_category: str = OTHER_CATEGORY
    sentinel: float = NUMERIC_SENTINEL
    tokens: tuple[str, ...] = MISSING_TOKENS
    row_id: str = "row_id"
    period: str = "period"
    partition: str = "partition"
    document: str = "key_value"
    customer: str = "codunicocli"
    campaign_group: str = "grp_campecs06m"
    contact_probability: str = "prob_value_contact"
    amount: str = "monto"
    target: str = "target"

    @property
    def categories(self) -> tuple[str, ...]:
        return (*self.allowed, self.other_category)

    @property
    def dummies(self) -> tuple[str, ...]:
        return tuple(f"{self.category}_{value}" for value in self.categories)

    @property
    def features(self) -> tuple[str, ...]:
        return (*self.numeric, *self.dummies)

    @property
    def post_columns(self) -> tuple[str, ...]:
        return (self.partition, self.document, self.customer, self.campaign_group,
                self.contact_probability, self.amount)


DEFAULT_SPEC = FeatureSpec()


@dataclass(frozen=True)
class MonitorParams:
    """Settings of a training or monitoring run."""

    model_name: str = "extrac"
    training_periods: tuple[int, ...] = (1, 2, 3, 4)
    monitoring_periods: tuple[int, ...] = (11, 12)
    moving_avg_window: int = 3
    top_n_vars: int = 15
    psi_quantiles: int = 1000
    score_col: str = "predictions"
    points_col: str = "puntuacion"
    group_col: str = "grupo_ejec"
    alert_duration_s: float = 30.0
    alert_ram_delta_mb: float = 200.0
    alert_ram_sys_pct: float = 80.0
    test_share: float = 0.33
    split_seed: int = 123
    model_seed: int = 42
    max_decay_pct: float = 10.0
    spec: FeatureSpec = field(default_factory=FeatureSpec)
