"""Every operator as a query over the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.catalog import fixtures as fx
from tidewatch.functions import columns as fn
from tidewatch.models import registry as reg
from tidewatch.models.learners import FAMILIES, batch_inference
from tidewatch.models.search import search
from tidewatch.models.training import evaluate, fit_candidates, prepare_sets
from tidewatch.operators import cleaning as C
from tidewatch.operators import drift as D
from tidewatch.operators import reports as R
from tidewatch.operators.delivery import attach_scores, postprocess, with_value_score
from tidewatch.operators.evaluation import auc_by_split, champion, roc_auc
from tidewatch.operators.ranking import (
    best_per_key, exact_split, execution_groups, hash_split, rank_rows,
)
from tidewatch.operators.quantiles import exact_cuts
from tidewatch.plans.monitoring import (
    monitor_stage, monitor_stages, run_monitoring_phase, stage_runs, store_run, summarise,
)
from tidewatch.plans.prepare import prepare, split_sets
from tidewatch.plans.training import run_training_phase
from tidewatch.runtime import materialize, new_folder, side_by_side
from tidewatch.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]

Q = 10
RUN_DATE = dt.date(2024, 1, 31)
SPEC = fx.SPEC


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})


def halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(monitored, reference) periods."""
    return fx.periods(df, fx.MONITORED_PERIODS), fx.periods(df, fx.REFERENCE_PERIODS)


# Sources and sinks

def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "orders").select(
        (F.year("o_orderdate") - 1994).alias("period"), "o_orderpriority", "o_totalprice")


def scan_period_union(spark, sf):
    """Period frames met by column name; the first one lacks a column."""
    orders, union = _orders(spark, sf), None
    for period in R.known_values(orders, "period"):
        part = orders.where(F.col("period") == period)
        part = part.drop("o_orderpriority") if period == 1 else part
        union = part if union is None else union.unionByName(part, allowMissingColumns=True)
    return union.groupBy("period").agg(
        F.count(F.lit(1)).alias("n"), F.count("o_orderpriority").alias("n_priority"),
        F.round(F.sum("o_totalprice"), 2).alias("total"))


def scan_csv_roundtrip(spark, sf):
    """Orders as period CSV files and as a parquet folder, read back by period list, by folder, and typed."""
    orders, csv, parquet = _orders(spark, sf), new_folder(spark, "csv"), new_folder(spark, "parquet")
    years = R.known_values(orders, "period")
    for period in years:
        writers.write_csv(orders.where(F.col("period") == period).drop("period"), f"{csv}/p{period}_extrac.csv")
    writers.write_table(orders, parquet)
    reads = {
        "csv": readers.read_periods(spark, csv, years),
        "folder": readers.read_folder(spark, csv),
        "parquet": readers.read_raw(spark, parquet, years, fmt="parquet"),
    }
    out = None
    for name, df in reads.items():
        part = df.groupBy("period").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("o_totalprice").cast("double")), 2).alias("total"))
        part = part.select(F.lit(name).alias("fmt"), "period", "n", "total")
        out = part if out is None else out.unionByName(part)
    return out


def scan_folder_by_name(spark, sf):
    """Period CSV files of one folder with their columns in other orders, some with one column more."""
    orders = fx.table(spark, sf, "orders").withColumn("period", F.year("o_orderdate") - 1994)
    folder = new_folder(spark, "folder")
    layouts = (["o_totalprice", "o_orderpriority"], ["o_orderpriority", "o_totalprice"],
               ["o_orderstatus", "o_totalprice", "o_orderpriority"])
    for period in R.known_values(orders, "period"):
        columns = layouts[period % len(layouts)]
        writers.write_csv(orders.where(F.col("period") == period).select(columns), f"{folder}/p{period}_extrac.csv")
    return readers.read_folder(spark, folder).groupBy("period").agg(
        F.count(F.lit(1)).alias("n"), F.count("o_orderpriority").alias("n_priority"),
        F.count("o_orderstatus").alias("n_status"), F.min("o_orderpriority").alias("first_priority"),
        F.round(F.sum(F.col("o_totalprice").cast("double")), 2).alias("total"))


# Cleaning and projections

def _texts(spark, sf):
    kind = F.col("o_orderkey") % 7
    text = (F.when(kind == 0, "").when(kind == 1, "null").when(kind == 2, "None")
            .otherwise(F.col("o_totalprice").cast("string")))
    return fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), text.alias("value"))


def clean_null_tokens(spark, sf):
    df = C.null_tokens(_texts(spark, sf), SPEC.tokens)
    return C.to_float32(df, ["value"]).select("row_id", F.col("value").cast("double").alias("value"))


def fill_sentinel(spark, sf):
    df = C.fill_sentinel(C.to_float32(fx.base(spark, sf), SPEC.numeric), SPEC.numeric, SPEC.sentinel)
    return df.select("row_id", *[F.col(c).cast("double").alias(c) for c in SPEC.numeric])


def missing_counts(spark, sf):
    return fx.base(spark, sf).groupBy("period").agg(*[F.count(c).alias(c) for c in SPEC.numeric])


def _customers(spark, sf):
    segment = F.when(F.col("c_custkey") % 13 != 0, F.col("c_mktsegment"))
    return fx.table(spark, sf, "customer").select("c_custkey", segment.alias("segment"))


def collapse_category(spark, sf):
    return C.collapse_categories(_customers(spark, sf), "segment", ("BUILDING", "MACHINERY"),
                                 SPEC.other_category, SPEC.missing_category)


def one_hot_forced(spark, sf):
    return C.one_hot(_customers(spark, sf), "segment", SPEC.categories)


def one_hot_discovered(spark, sf):
    return C.one_hot(_customers(spark, sf), "segment")


def _prepared(spark, sf):
    return C.clean_features(fx.base(spark, sf), SPEC)


def project_features(spark, sf):
    df = C.project_features(_prepared(spark, sf), SPEC)
    return df.select("row_id", "period", *[F.col(c).cast("double").alias(c) for c in SPEC.features])


def project_post(spark, sf):
    return rounded(C.project_post(_prepared(spark, sf), SPEC), "prob_value_contact")


def feature_tables(spark, sf):
    """Features, attributes and scores written as three tables and read back."""
    clean, paths = _prepared(spark, sf), {n: new_folder(spark, n) for n in ("features", "post", "scores")}
    writers.write_features(clean, SPEC, paths["features"])
    writers.write_post(clean, SPEC, paths["post"])
    writers.write_scores(fx.scored(spark, sf), SPEC, paths["scores"], "prob")
    out = None
    for name, column in (("features", "sum_qty"), ("post", "monto"), ("scores", "prob")):
        value = F.col(column).cast("double")
        part = spark.read.parquet(paths[name]).groupBy("period").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.min(value), 6).alias("low"), F.round(F.max(value), 6).alias("high"))
        part = part.select(F.lit(name).alias("name"), "period", "n", "low", "high")
        out = part if out is None else out.unionByName(part)
    return out


def scan_quarantine(spark, sf):
    """A folder in which every 25th row has a field too many and one file has no header: rows kept and rows put aside."""
    orders = fx.table(spark, sf, "orders").withColumn("period", F.year("o_orderdate") - 1994)
    folder = new_folder(spark, "quarantine")
    extra = F.when(F.col("o_orderkey") % 25 == 0, ",torn").otherwise("")
    line = F.concat(F.col("o_totalprice").cast("double").cast("string"), F.lit(","), F.col("o_orderpriority"), extra)
    for period in R.known_values(orders, "period"):
        here = orders.where(F.col("period") == period).select(line.alias("price,priority"))
        here.write.option("header", True).option("sep", "|").csv(f"{folder}/p{period}_extrac.csv")
    orders.limit(0).select("o_orderkey").write.csv(f"{folder}/p99_extrac.csv")
    rows, rejected = readers.read_folder_checked(spark, folder)
    price = F.col("price").cast("double")
    kept = rows.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.round(F.max(price), 2).alias("highest"))
    aside = rejected.groupBy(F.col("period").alias("_period")).agg(
        F.count("record").alias("n_rejected"), F.count_if(F.col("record").endswith(",torn")).alias("n_torn"))
    return kept.join(aside, F.col("period") == F.col("_period"), "left").select("period", "n", "highest", "n_rejected", "n_torn")


def rerun_period(spark, sf):
    """Scores of period 5, then 6, then 5 again with other rows: the second run of 5 replaces the first, 6 stays."""
    scored, path = fx.scored(spark, sf), new_folder(spark, "scores")
    for period, some in ((5, F.lit(True)), (6, F.lit(True)), (5, F.col("row_id") % 3 != 0)):
        writers.write_scores(fx.periods(scored, [period]).where(some), SPEC, path, "prob")
    return spark.read.parquet(path).groupBy("period").agg(
        F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("ids"), F.round(F.max("prob"), 6).alias("highest"))


def promotion_race(spark, sf):
    """Every candidate's AUC logged as a run and promoted, all at the same moment: runs and versions read back."""
    root = new_folder(spark, "race")
    found = roc_auc(_candidate_scores(spark, sf), "score", "label", ["ml_name", "is_test"]).collect()

    def promoted(row):
        name = f"{row['ml_name']}-{'test' if row['is_test'] else 'train'}"
        reg.log_run(spark, f"{root}/_runs", name, row["ml_name"], {"is_test": row["is_test"]},
                    {"auc": row["auc"], "n_pos": row["n_pos"]})
        return reg.promote(spark, root, "extrac", name, row["auc"])

    side_by_side(spark, [partial(promoted, row) for row in found], len(found), "promotion")
    versions = reg.registry(spark, root)
    logged = reg.runs(spark, f"{root}/_runs").select(
        F.col("run_id").alias("folder"), "name", F.round(F.col("metrics")["auc"], 6).alias("auc"),
        F.col("metrics")["n_pos"].cast("bigint").alias("n_pos"), (F.col("params")["is_test"] == "True").alias("is_test"))
    numbers = versions.agg(F.sort_array(F.collect_list("version")).alias("numbers"))
    # One row.
    return versions.join(logged, "folder").crossJoin(F.broadcast(numbers)).select(
        "name", "is_test", "n_pos", "auc", F.array_join("numbers", ",").alias("versions"))


def _order_ids(spark, sf):
    return fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"))


def hash_split_query(spark, sf):
    return hash_split(_order_ids(spark, sf), "row_id")


def exact_split_query(spark, sf):
    return exact_split(_order_ids(spark, sf), "row_id")


def normalise_types(spark, sf):
    lines = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"),
        (F.col("l_returnflag") == "R").alias("returned"), (F.col("l_extendedprice") / 7).alias("seventh"),
        F.col("l_tax").cast("float").alias("l_tax"))
    return C.normalise_types(lines)


def align_columns(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return C.align_columns(orders, ["o_totalprice", "brand_new", "o_custkey"], keep=["o_orderkey"])


# Drift

WATCHED = (*fx.REFERENCE_PERIODS, *fx.MONITORED_PERIODS)
FIRST_AND_MONITORED = (1, *fx.MONITORED_PERIODS)


def _base(spark, sf, wanted: Sequence[int] | None = WATCHED):
    """The stand-in table, stored once: reference and monitored periods are read from it several times."""
    return fx.stored(fx.base(spark, sf, wanted), "base")


def _features(base: DataFrame) -> DataFrame:
    return fx.stored(C.project_features(C.clean_features(base, SPEC), SPEC), "features")


def quantile_edges(spark, sf):
    reference = fx.periods(_base(spark, sf), fx.REFERENCE_PERIODS)
    return rounded(exact_cuts(reference, fx.NUMERIC, Q), "edge")


def drift_bins(spark, sf):
    bins = D.drift_bins(*halves(_base(spark, sf)), fx.NUMERIC, Q)
    return rounded(bins, "lo", "hi", "ref_share", "act_share", "psi_term", "kl_term")


def psi_report_raw(spark, sf):
    report = D.psi_report(*halves(_base(spark, sf)), Q, fx.NUMERIC)
    return report.withColumn("status", fn.status_band(F.col("psi")))


def psi_report_q1000(spark, sf):
    return D.psi_report(*halves(_base(spark, sf)), 1000, fx.NUMERIC)


def psi_report_pre(spark, sf):
    return D.psi_report(*halves(_features(fx.base(spark, sf, WATCHED))), Q, SPEC.features)


def kl_report(spark, sf):
    monitored, reference = halves(_base(spark, sf).select("period", *fx.NUMERIC))
    return rounded(D.data_drift("KL", monitored, reference, Q), "metric_value")


def psi_q1000_ties(spark, sf):
    lines = fx.table(spark, sf, "lineitem").select(
        (F.year("l_shipdate") - 1994).alias("period"), "l_quantity", "l_discount", "l_tax")
    return D.psi_report(*halves(lines), 1000)


def _shifted(scored: DataFrame) -> DataFrame:
    """A score that moves in period 6."""
    score = F.when(F.col("period") == 6, F.col("prob") * 0.8).otherwise(F.col("prob"))
    return scored.select("period", score.alias("predictions"))


def score_drift(spark, sf):
    shifted = fx.stored(_shifted(fx.scored(spark, sf, FIRST_AND_MONITORED)), "shifted")
    return D.score_drift(fx.periods(shifted, fx.MONITORED_PERIODS), fx.periods(shifted, [1]), "predictions", Q)


def _replica(base: DataFrame, periods: Sequence[int] | None = None) -> DataFrame:
    scored = fx.with_score(base)
    return postprocess(fx.periods(scored, periods) if periods else scored, SPEC, RUN_DATE)


def _stored_replica(base: DataFrame, periods: Sequence[int]) -> DataFrame:
    return fx.stored(_replica(base, periods).select("period", "grupo_ejec", "score", "puntuacion"), "replica")


def _group_drift(spark, sf):
    replica = _stored_replica(_base(spark, sf, FIRST_AND_MONITORED), FIRST_AND_MONITORED)
    return D.group_drift(fx.periods(replica, fx.MONITORED_PERIODS), fx.periods(replica, [1]), "grupo_ejec",
                         ["score", "puntuacion"], Q)


def group_drift(spark, sf):
    return _group_drift(spark, sf)


def _group_means(base: DataFrame, monitored: Sequence[int]) -> DataFrame:
    replica = _stored_replica(base, sorted({1, *monitored}))
    return D.mean_psi(D.group_drift(fx.periods(replica, monitored), fx.periods(replica, [1]), "grupo_ejec",
                                    ["score", "puntuacion"], Q))


def reference_self_check(spark, sf):
    """In-sample drift: raw against the first period, prepared against all, scores and groups of the first
    period against themselves."""
    base = _base(spark, sf)
    prepared = _features(base)
    later = (2, 3, 4)
    score = fx.periods(fx.with_score(base).select("period", F.col("prob").alias("predictions")), [1])
    summary = R.stage_summary({
        "raw": D.mean_psi(D.psi_report(fx.periods(base, later), fx.periods(base, [1]), Q, fx.NUMERIC)),
        "pre": D.mean_psi(D.psi_report(fx.periods(prepared, later), fx.periods(prepared, fx.REFERENCE_PERIODS), Q,
                                       SPEC.features)),
        "score": D.mean_psi(D.score_drift(score, score, "predictions", Q)),
        "grupo": _group_means(base, [1]),
    })
    return rounded(summary, "psi_medio")


def stage_summary(spark, sf):
    """All four stages of the monitored periods, failures kept apart, with status."""
    base, monitored = _base(spark, sf), fx.MONITORED_PERIODS
    shifted = _shifted(fx.with_score(base))
    prepared = _features(base)
    replica = _stored_replica(base, (1, *monitored))
    reports = {
        "raw": lambda: D.psi_report(*halves(base), Q, fx.NUMERIC),
        "pre": lambda: D.psi_report(*halves(prepared), Q, SPEC.features),
        "score": lambda: D.score_drift(fx.periods(shifted, monitored), fx.periods(shifted, [1]), "predictions", Q),
        "grupo": lambda: D.group_drift(fx.periods(replica, monitored), fx.periods(replica, [1]), "grupo_ejec",
                                       ["score", "puntuacion"], Q),
    }
    return rounded(summarise(monitor_stages(spark, reports, monitored)), "psi_medio")


# Scoring and delivery

def value_score(spark, sf):
    """Attributes and scores kept in two tables, met on row identity."""
    scores = fx.scored(spark, sf).select("row_id", "period", F.col("prob").alias("predictions"))
    df = attach_scores(fx.base(spark, sf), scores, SPEC)
    return rounded(with_value_score(df, SPEC).select("row_id", "period", "puntuacion"), "puntuacion")


def _valued(spark, sf):
    return with_value_score(fx.scored(spark, sf), SPEC).select("row_id", "period", "key_value", "puntuacion")


def exec_groups(spark, sf):
    valued = fx.stored(_valued(spark, sf), "valued")
    return execution_groups(valued, "puntuacion").select("row_id", "period", "grupo_ejec")


def _best_first():
    return [F.desc_nulls_last("puntuacion"), F.asc("row_id")]


def dedup_best(spark, sf):
    best = best_per_key(_valued(spark, sf), ["period", "key_value"], _best_first())
    return best.select("period", "key_value", "row_id")


def order_rank(spark, sf):
    rows = _valued(spark, sf).select("row_id", "period", "puntuacion")
    return rank_rows(rows, _best_first(), by=("period",)).select("row_id", "period", "orden")


def delivery_file(spark, sf):
    return rounded(_replica(_base(spark, sf, None)), "puntuacion", "score")


def delivery_roundtrip(spark, sf):
    replica = materialize(_replica(_base(spark, sf, None)), "replica")
    path = writers.write_delivery(replica, new_folder(spark, "delivery"))
    df = readers.read_delivery(spark, path)
    return rounded(df.select("period", "codmes", "coddoc", "grupo_ejec", "score", "orden", "variable1", "variable2"),
                   "score")


# Reports

def _history(spark, sf):
    psi = F.when(F.col("period") % 7 != 0, F.round(F.col("duration_s") / 100, 5))
    return fx.stage_runs(spark, sf).select("stage", "period", psi.alias("psi_medio"))


def rolling_psi(spark, sf):
    df = D.rolling_psi(_history(spark, sf), 3)
    return rounded(df.select("stage", "period", "rolling_psi"), "rolling_psi")


def run_summary(spark, sf):
    return R.run_summary(_history(spark, sf))


def psi_matrix_topn(spark, sf):
    report = D.psi_report(*halves(_base(spark, sf)), Q, fx.NUMERIC)
    return R.psi_matrix(report, fx.MONITORED_PERIODS, 5)


def score_density(spark, sf):
    scored = fx.stored(fx.scored(spark, sf).select("period", "prob"), "scored")
    return rounded(R.score_density(scored, "prob"), "lo", "hi", "density")


def stage_period_grid(spark, sf):
    history = _history(spark, sf)
    return rounded(R.stage_grid(history, R.known_values(history, "period")), "rolling_psi")


def group_matrix(spark, sf):
    return R.group_matrix(_group_drift(spark, sf), fx.MONITORED_PERIODS)


def traffic_light(spark, sf):
    history = _history(spark, sf)
    return R.traffic_light(history, R.known_values(history, "period"))


def ops_timeline(spark, sf):
    return R.ops_timeline(fx.stage_runs(spark, sf), _history(spark, sf))


def ops_alerts(spark, sf):
    return R.ops_alerts(fx.stage_runs(spark, sf))


def ops_first_alerts(spark, sf):
    return R.first_alerts(ops_alerts(spark, sf)).select("kind_no", "stage", "period")


def ops_duration_pivot(spark, sf):
    return rounded(R.duration_pivot(fx.stage_runs(spark, sf)), "ram_sys_pct")


def ops_ram_pivot(spark, sf):
    runs = fx.stage_runs(spark, sf)
    return R.memory_pivot(runs, R.known_values(runs, "period"))


def metric_history(spark, sf):
    return R.metric_history(_history(spark, sf), "run-1")


# Models

def latest_model(spark, sf):
    """Folder names made from event times; those of errors do not parse."""
    stamp = F.date_format("ts", "yyyy-MM-dd_HH-mm-ss")
    name = F.when(F.col("event_type") == "error", F.concat(F.lit("draft_"), stamp)).otherwise(stamp)
    return R.latest(fx.table(spark, sf, "events").select(name.alias("folder")))


def _label():
    noise = fn.hash_fraction(F.col("row_id"), 99) % 100 < 20
    return ((F.coalesce("sum_price", F.lit(0)) > 100000) != noise).cast("int")


def _candidate_scores(spark, sf):
    """Three given scores per row, with label and split."""
    rows = hash_split(fx.scored(spark, sf), "row_id").select(
        "is_test", _label().alias("label"), F.coalesce("sum_price", F.lit(0.0)).alias("gbt"),
        F.round("prob", 9).alias("forest"), F.round(F.col("o_totalprice") / 50000).alias("logistic"))
    return rows.unpivot(["is_test", "label"], list(FAMILIES), "ml_name", "score")


def roc_auc_query(spark, sf):
    return rounded(roc_auc(_candidate_scores(spark, sf), "score", "label", ["ml_name", "is_test"]), "auc")


def _decay(spark, sf):
    return auc_by_split(_candidate_scores(spark, sf), "score", "label", "is_test", ["ml_name"])


def auc_decay(spark, sf):
    return rounded(_decay(spark, sf), "auc_train", "auc_test", "decay_percent")


def champion_query(spark, sf):
    return rounded(champion(_decay(spark, sf), FAMILIES).select("ml_name", "auc_test"), "auc_test")


def raw_with_target(spark, sf):
    return fx.base(spark, sf).withColumn("target", _label())


def _sets(spark, sf):
    prepared = materialize(
        prepare(fx.periods(raw_with_target(spark, sf), fx.REFERENCE_PERIODS), SPEC, with_target=True), "prepared")
    train, test = split_sets(prepared, SPEC)
    return prepare_sets(train, test, SPEC.target, keep=[SPEC.row_id])


def _evaluated(metrics: DataFrame) -> DataFrame:
    """What holds of any fit: AUCs better than chance and at most 1, and the decay that follows from them."""
    train, test = F.col("auc_train"), F.col("auc_test")
    return metrics.select(
        "ml_name", (train.between(0.5, 1) & test.between(0.5, 1)).alias("auc_in_bounds"),
        (F.abs(F.col("decay_percent") - (train - test) / train * 100) < 1e-9).alias("decay_holds"),
        (F.col("training_time_segs") > 0).alias("timed"))


def train_candidates(spark, sf):
    train, test, features = _sets(spark, sf)
    return _evaluated(evaluate(fit_candidates(train, features, SPEC.target, SPEC.row_id), train, test, SPEC.target))


def hpo_search(spark, sf):
    train, test, features = _sets(spark, sf)
    found = search(train, features, SPEC.target, SPEC.row_id)
    return _evaluated(evaluate(found, train, test, SPEC.target))


def batch_inference_query(spark, sf):
    train, _, features = _sets(spark, sf)
    fitted = fit_candidates(train, features, SPEC.target, SPEC.row_id, families=["logistic"])
    scored = batch_inference(fitted[0].model, prepare(fx.base(spark, sf), SPEC), ["row_id", "period"])
    return scored.select("row_id", "period", F.col("predictions").between(0, 1).alias("is_probability"))


def model_registry(spark, sf):
    """Two training runs stored, promoted and looked up."""
    train, test, features = _sets(spark, sf)
    root = new_folder(spark, "models")
    for day, family in enumerate(("logistic", "forest"), start=1):
        fitted = fit_candidates(train, features, SPEC.target, SPEC.row_id, [family])
        row = evaluate(fitted, train, test, SPEC.target).first().asDict()
        folder = reg.save_model(spark, fitted[0], row, root, dt.datetime(2024, 1, day))
        reg.promote(spark, root, "extrac", folder, row["auc_test"])
    return reg.registry(spark, root).select(
        "model_name", "folder", "version", "stage", F.col("auc_test").between(0.5, 1).alias("auc_in_bounds"))


def _phase(spark, sf) -> tuple[DataFrame, str]:
    raw = fx.stored(raw_with_target(spark, sf), "raw")
    root = new_folder(spark, "engine")
    return raw, root


def training_phase(spark, sf):
    raw, root = _phase(spark, sf)
    summary = run_training_phase(spark, raw, fx.PARAMS, root, RUN_DATE)["stage_summary"]
    return rounded(summary, "psi_medio").withColumn("has_result", F.col("psi_medio").isNotNull())


def monitoring_phase(spark, sf):
    """All stages have a result; the drift of scores and groups hangs on the fitted model and is not shown."""
    raw, root = _phase(spark, sf)
    run_training_phase(spark, raw, fx.PARAMS, root, RUN_DATE)
    summary = run_monitoring_phase(spark, raw.drop("target"), fx.PARAMS, root, RUN_DATE)["stage_summary"]
    fixed = F.col("stage").isin("raw", "pre")
    return rounded(summary, "psi_medio").select(
        "stage", "period", *[F.when(fixed, F.col(c)).alias(c) for c in ("psi_medio", "status", "colour")],
        F.col("psi_medio").isNotNull().alias("has_result"))


def _two_stages(spark, sf):
    """Two stages, one of which fails: the base has no scores."""
    base, monitored = _base(spark, sf), fx.MONITORED_PERIODS
    return [
        monitor_stage(spark, "raw", lambda: D.psi_report(*halves(base), Q, fx.NUMERIC), monitored),
        monitor_stage(spark, "score", lambda: D.score_drift(*halves(base), "predictions", Q), monitored),
    ]


def stage_run_records(spark, sf):
    """Operational rows of two stages, one of which fails and is kept with its error."""
    results, monitored = _two_stages(spark, sf), fx.MONITORED_PERIODS
    timeline = R.ops_timeline(stage_runs(spark, results, monitored), summarise(results))
    timed = (F.col("duration_s") > 0).alias("timed")
    return rounded(timeline.select("stage", "period", timed, "ram_delta_mb", "psi_medio"), "psi_medio")


def stored_run(spark, sf):
    """Stage records of a run, met with its stored drift reports and metric history, read back from their tables."""
    root = new_folder(spark, "engine")
    store_run(spark, root, "run-1", _two_stages(spark, sf), fx.MONITORED_PERIODS, dt.datetime(2024, 1, 31, 8, 30))
    records, history, report = (spark.read.parquet(f"{root}/{n}") for n in ("stage_records", "metric_history", "drift_raw"))
    named = records.withColumn("name", F.format_string("psi_%s_p%d", "stage", "period"))
    worst = report.groupBy("run_id", "period").agg(F.max("psi").alias("worst")).withColumn("stage", F.lit("raw"))
    joined = (named.join(history.drop("ts"), ["run_id", "name"], "left")
              .join(worst, ["run_id", "stage", "period"], "left"))
    return joined.select(
        "run_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("at"), "stage", "period",
        F.col("error").isNotNull().alias("failed"), "report_rows", "values_compared",
        F.round("psi_medio", 6).alias("psi_medio"), F.round("value", 6).alias("value"), "worst")


def queries() -> dict[str, Query]:
    plain = [
        scan_period_union, scan_csv_roundtrip, clean_null_tokens, fill_sentinel, missing_counts, collapse_category,
        one_hot_forced, one_hot_discovered, project_features, project_post, normalise_types, align_columns,
        quantile_edges, drift_bins, psi_report_raw, psi_report_q1000, psi_report_pre, kl_report, psi_q1000_ties,
        score_drift, group_drift, reference_self_check, stage_summary, rolling_psi, run_summary, value_score,
        exec_groups, dedup_best, order_rank, delivery_file, delivery_roundtrip, psi_matrix_topn, score_density,
        stage_period_grid, group_matrix, traffic_light, ops_timeline, ops_alerts, ops_first_alerts,
        ops_duration_pivot, ops_ram_pivot, metric_history, latest_model, auc_decay, train_candidates, hpo_search,
        model_registry, training_phase, monitoring_phase, stage_run_records, stored_run,
        scan_folder_by_name, feature_tables, scan_quarantine, rerun_period, promotion_race,
    ]
    named = {f.__name__: f for f in plain}
    named.update(hash_split=hash_split_query, exact_split=exact_split_query, roc_auc=roc_auc_query,
                 champion=champion_query, batch_inference=batch_inference_query)
    return named
