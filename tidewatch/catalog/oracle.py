"""The same queries as plain SQL, written on their own from the definitions: whole-table windows and
counts, where the Spark side uses ranges, partial counts and binary searches."""

from __future__ import annotations

NUMERIC = ["o_totalprice", "c_acctbal", "n_lines", "sum_qty", "sum_price", "avg_discount", "avg_tax"]
INNER_PER_MILLE = [35, 87, 237, 393, 529, 664, 787, 862, 950]

BASE = """
base as (
  select o.o_orderkey as row_id,
         cast(year(o.o_orderdate) - 1994 as int) as period,
         cast(year(o.o_orderdate) * 100 + month(o.o_orderdate) as varchar) as codmes,
         o.o_custkey as key_value, c.c_custkey as codunicocli,
         case o.o_orderpriority when '1-URGENT' then 'G1' when '2-HIGH' then 'G2'
              when '3-MEDIUM' then 'G3' when '4-NOT SPECIFIED' then 'G4' end as grp,
         case when o.o_orderkey % 11 = 0 then null
              else (o.o_orderkey % 97 + 1) / 100::double end as prob_value_contact,
         o.o_totalprice as monto, c.c_mktsegment as segment,
         o.o_totalprice, c.c_acctbal, l.n_lines, l.sum_qty, l.sum_price, l.avg_discount, l.avg_tax
  from orders o
  join customer c on o.o_custkey = c.c_custkey
  left join (select l_orderkey, count(*)::double as n_lines, sum(l_quantity) as sum_qty,
                    round(sum(l_extendedprice), 2) as sum_price,
                    round(avg(l_discount), 6) as avg_discount, round(avg(l_tax), 6) as avg_tax
             from lineitem group by l_orderkey) l on l.l_orderkey = o.o_orderkey)"""

SCORED = BASE + """,
scored as (
  select *, 1 / (1 + exp(-(coalesce(c_acctbal, 0) / 5000 - 1 + coalesce(sum_qty, 0) / 200
                           - coalesce(avg_discount, 0) * 10))) as prob
  from base)"""

PREPARED = BASE + """,
prepared as (
  select row_id, period, """ + ", ".join(
    f"coalesce({c}::float, -9999999::float)::double as {c}" for c in NUMERIC) + """,
         (segment = 'BUILDING')::int::double as segment_BUILDING,
         (segment <> 'BUILDING')::int::double as segment_OTRO
  from base)"""
PREPARED_FEATURES = [*NUMERIC, "segment_BUILDING", "segment_OTRO"]

VALUED = SCORED + """,
valued as (
  select *, prob * coalesce(prob_value_contact, 0.000001::double)
              * (case when monto > -1 then ln(monto + 1) end)
              * (case grp when 'G1' then 0.066 when 'G2' then 0.028 when 'G3' then 0.022
                          when 'G4' then 0.008 else 0.004 end)::double as puntuacion
  from scored)"""

GROUPED = VALUED + """,
points as (
  select period, puntuacion, row_number() over (partition by period order by puntuacion) - 1 as pos,
         count(*) over (partition by period) as n
  from valued where puntuacion is not null),
point_cuts as (
  select distinct period, n, i, (i * (n - 1)) // 1000 as k, (i * (n - 1)) % 1000 as m
  from points, (select unnest([INNER])::bigint as i)),
point_edges as (
  select c.period, c.i, a.puntuacion + (coalesce(b.puntuacion, a.puntuacion) - a.puntuacion) * (c.m / 1000::double) as edge
  from point_cuts c
  join points a on a.period = c.period and a.pos = c.k
  left join points b on b.period = c.period and b.pos = c.k + 1),
grouped as (
  select v.*, case when puntuacion is not null then (10 - (
           select count(*) from point_edges e where e.period = v.period and v.puntuacion > e.edge))::int end as grupo_ejec
  from valued v)""".replace("INNER", ", ".join(map(str, INNER_PER_MILLE)))

DELIVERED = GROUPED + """,
best as (
  select * from grouped
  qualify row_number() over (partition by period, key_value order by puntuacion desc nulls last, row_id) = 1),
delivered as (
  select period, codmes, '1' as tipdoc, key_value as coddoc, puntuacion, 'EC OMNICANAL' as modelo,
         '20240131' as fec_replica, grupo_ejec, prob as score,
         (row_number() over (partition by period order by puntuacion desc nulls last, row_id))::int as orden,
         case when length(codunicocli::varchar) >= 10 then codunicocli::varchar
              else lpad(codunicocli::varchar, 10, '0') end as variable1,
         monto as variable2, '' as variable3
  from best)"""


def long_form(name: str, source: str, columns: list[str], keys: str, where: str = "true") -> str:
    parts = [f"select {keys}, '{c}' as feature, ({c})::double as value from {source} where {where}"
             for c in columns]
    return f"{name} as ({' union all '.join(parts)})"


def drift(tag: str, q: int, by: str = "") -> str:
    """CTEs `{tag}_edges`, `{tag}_terms` and `{tag}_psi` from `{tag}_ref` (by, feature, value) and `{tag}_act`
    (by, period, feature, value)."""
    g = f"{by}, " if by else ""

    def same(a: str, b: str) -> str:
        on = f"{a}.feature = {b}.feature"
        return f"{on} and {a}.{by} = {b}.{by}" if by else on

    def binned(side: str, period: str) -> str:
        return f"""
          select {g}{period}feature, bin, count(*) as rows_n from (
            select {', '.join('v.' + c for c in ([by] if by else []) + (['period'] if period else []) + ['feature'])},
                   case when v.value is not null then coalesce(e.i, 0) end as bin
            from {tag}_{side} v asof left join {tag}_steps e on {same('v', 'e')} and v.value >= e.edge)
          group by all"""

    return f"""
{tag}_rank as (
  select {g}feature, value, row_number() over (partition by {g}feature order by value) - 1 as pos,
         count(*) over (partition by {g}feature) as n
  from {tag}_ref where value is not null),
{tag}_cuts as (
  select distinct {g}feature, n, i, (i * (n - 1)) // {q} as k, (i * (n - 1)) % {q} as m
  from {tag}_rank, (select unnest(generate_series(1, {q - 1}))::bigint as i)),
{tag}_edges as (
  select {', '.join('c.' + c for c in ([by] if by else []) + ['feature'])}, c.n, c.i,
         a.value + (coalesce(b.value, a.value) - a.value) * (c.m / {q}::double) as edge
  from {tag}_cuts c join {tag}_rank a on {same('c', 'a')} and a.pos = c.k
  left join {tag}_rank b on {same('c', 'b')} and b.pos = c.k + 1),
{tag}_steps as (select {g}feature, edge, max(i) as i from {tag}_edges group by all),
{tag}_ref_bins as ({binned('ref', '')}),
{tag}_act_bins as ({binned('act', 'period, ')}),
{tag}_ref_n as (select {g}feature, sum(rows_n)::bigint as rows_ref,
                       sum(case when bin is not null then rows_n end)::bigint as n_ref
                from {tag}_ref_bins group by all),
{tag}_act_n as (select {g}period, feature, sum(rows_n)::bigint as rows_actual,
                       sum(case when bin is not null then rows_n end)::bigint as n_actual
                from {tag}_act_bins group by all),
{tag}_grid as (
  select a.*, r.rows_ref, r.n_ref, bin
  from {tag}_act_n a join {tag}_ref_n r on {same('a', 'r')}, (select unnest(generate_series(0, {q - 1})) as bin)),
{tag}_shares as (
  select g.*, case when coalesce(r.rows_n, 0) = 0 then 1e-6::double else r.rows_n / g.n_ref::double end as r,
         case when coalesce(a.rows_n, 0) = 0 then 1e-6::double else a.rows_n / g.n_actual::double end as a
  from {tag}_grid g
  left join {tag}_ref_bins r on {same('g', 'r')} and r.bin = g.bin
  left join {tag}_act_bins a on {same('g', 'a')} and a.bin = g.bin and a.period = g.period),
{tag}_psi as (
  select {g}period, feature, n_ref, n_actual, rows_ref, rows_actual,
         sum((r - a) * ln(r / a)) as psi, sum(r * ln(r / a)) as kl
  from {tag}_shares group by all)"""


REF, ACT = "period between 1 and 4", "period in (5, 6)"
BAND = "case when {0} is null then null when {0} < 0.10 then 'OK' when {0} < 0.25 then 'WARN' else 'ALARM' end"
COLOUR = ("case when {0} is null then null when {0} < 0.10 then '#27ae60' when {0} < 0.25 then '#f39c12' "
          "else '#e74c3c' end")
ENOUGH = "n_ref > 10 and n_actual > 10"


def sides(tag: str, source: str, columns: list[str], q: int, by: str = "", ref: str = REF, act: str = ACT) -> str:
    g = f"{by}, " if by else ""
    keys = by if by else "period"
    return ",\n".join([
        long_form(f"{tag}_ref", source, columns, keys, ref),
        long_form(f"{tag}_act", source, columns, f"{g}period", act), drift(tag, q, by)])


RAW = f"with {BASE}, {sides('d', 'base', NUMERIC, 10)}"
TIES = f"""with lines as (select cast(year(l_shipdate) - 1994 as int) as period, l_quantity, l_discount, l_tax from lineitem),
{sides('d', 'lines', ['l_quantity', 'l_discount', 'l_tax'], 1000)}"""
GROUP_SIDES = sides('g', 'members', ['score', 'puntuacion'], 10, 'grupo_ejec', 'period = 1', ACT)
GROUP = f"""with {DELIVERED},
members as (select * from delivered where grupo_ejec is not null), {GROUP_SIDES},
group_report as (
  select period, grupo_ejec, feature as columna, round_even(psi, 5) as psi, rows_actual as n_actual
  from g_psi where rows_ref >= 10 and rows_actual >= 10 and n_ref > 0 and n_actual > 0)"""

# A score that moves in period 6, so that drift is found.
SHIFTED = SCORED + """,
shifted as (select period, case when period = 6 then prob * 0.8 else prob end as predictions from scored)"""


def self_check() -> str:
    raw = sides("w", "base", NUMERIC, 10, ref="period = 1", act="period between 2 and 4")
    pre = sides("p", "prepared", PREPARED_FEATURES, 10, ref=REF, act="period between 2 and 4")
    score = sides("s", "scored_only", ["predictions"], 10, ref="period = 1", act="period = 1")
    group = sides("g", "members", ["score", "puntuacion"], 10, "grupo_ejec", "period = 1", "period = 1")
    return f"""with {DELIVERED}, {PREPARED[len(BASE) + 1:]},
scored_only as (select period, prob as predictions from scored),
members as (select * from delivered where grupo_ejec is not null),
{raw}, {pre}, {score}, {group}
select stage, period::int as period, round(psi_medio, 6) as psi_medio from (
  select 'raw' as stage, period, avg(round_even(psi, 5)) as psi_medio from w_psi where {ENOUGH} group by period
  union all select 'pre', period, avg(round_even(psi, 5)) from p_psi where {ENOUGH} group by period
  union all select 'score', period, avg(round_even(psi, 5)) from s_psi where {ENOUGH} group by period
  union all select 'grupo', period, avg(round_even(psi, 5)) from g_psi
            where rows_ref >= 10 and rows_actual >= 10 group by period)"""


PHASE_COLUMNS = ["key_value", "codunicocli", "prob_value_contact", "monto", *NUMERIC]


def phase(reference: str, watched: str, rest: str) -> str:
    """Raw and prepared drift of a phase; `rest` are the rows of the stages that stand on the fitted model."""
    raw = sides("w", "base", PHASE_COLUMNS, 10, ref=reference, act=watched)
    pre = sides("p", "prepared", PREPARED_FEATURES, 10, ref=REF, act=watched)
    return f"""with {PREPARED}, {raw}, {pre},
means as (
  select 'raw' as stage, period, avg(round_even(psi, 5)) as psi_medio from w_psi where {ENOUGH} group by period
  union all select 'pre', period, avg(round_even(psi, 5)) from p_psi where {ENOUGH} group by period
  union all {rest})
select stage, period::int as period, round(psi_medio, 6) as psi_medio,
       {BAND.format('psi_medio')} as status, {COLOUR.format('psi_medio')} as colour, true as has_result from means"""


def all_stages() -> str:
    raw = sides("w", "base", NUMERIC, 10)
    pre = sides("p", "prepared", PREPARED_FEATURES, 10)
    score = sides("s", "shifted", ["predictions"], 10, ref="period = 1")
    group = sides("g", "members", ["score", "puntuacion"], 10, "grupo_ejec", "period = 1", ACT)
    return f"""with {DELIVERED}, {PREPARED[len(BASE) + 1:]}, {SHIFTED[len(SCORED) + 1:]},
members as (select * from delivered where grupo_ejec is not null),
{raw}, {pre}, {score}, {group},
means as (
  select 'raw' as stage, period, avg(round_even(psi, 5)) as psi_medio from w_psi where {ENOUGH} group by period
  union all select 'pre', period, avg(round_even(psi, 5)) from p_psi where {ENOUGH} group by period
  union all select 'score', period, avg(round_even(psi, 5)) from s_psi where {ENOUGH} group by period
  union all select 'grupo', period, avg(round_even(psi, 5)) from g_psi
            where rows_ref >= 10 and rows_actual >= 10 group by period)
select stage, period::int as period, round(psi_medio, 6) as psi_medio,
       {BAND.format('psi_medio')} as status, {COLOUR.format('psi_medio')} as colour from means"""


RUNS = """
runs as (
  select case event_type when 'view' then 'raw' when 'click' then 'pre' when 'purchase' then 'score'
                         when 'signup' then 'grupo' end as stage,
         day(ts)::int as period, round(avg(value) * 0.6, 2) as duration_s,
         round(max(value::decimal(18,2)) - min(value::decimal(18,2)), 1)::double as ram_delta_mb,
         least(round(avg(value) * 1.6, 1), 100.0::double) as ram_sys_pct
  from events where event_type <> 'error' group by all),
history as (
  select stage, period, case when period % 7 <> 0 then round(duration_s / 100, 5) end as psi_medio from runs)"""
STAGE_LIST = "['raw', 'pre', 'score', 'grupo']"
GRID = f"""
grid as (select s.stage, p.period from (select unnest({STAGE_LIST}) as stage) s,
                (select unnest(generate_series(1, 30))::int as period) p),
dense as (select g.stage, g.period, h.psi_medio from grid g
          left join history h on h.stage = g.stage and h.period = g.period)"""


def rolled(source: str, window: int = 3) -> str:
    """CTE `rolled`: mean of the last earlier results, by numbering those that have one."""
    return f"""
pairs as (
  select d.stage, d.period, o.psi_medio,
         row_number() over (partition by d.stage, d.period order by o.period desc) as back
  from {source} d join {source} o on o.stage = d.stage and o.period < d.period and o.psi_medio is not null),
rolled as (
  select d.stage, d.period, d.psi_medio, coalesce(r.mean, 0.0::double) as rolling_psi
  from {source} d left join (select stage, period, avg(psi_medio) as mean from pairs where back <= {window} group by all) r
    on r.stage = d.stage and r.period = d.period)"""


LIGHT = "case when {0} is null then '—' else printf('%s %.3f', " + BAND + ", round_even({0}, 3)) end"

HASH8 = "('0x' || substr(md5({0}::varchar || '{1}'), 1, 8))::bigint"
HASH13 = "('0x' || substr(md5({0}::varchar || '{1}'), 1, 13))::bigint"

CANDIDATES = SCORED + f""",
candidates as (
  select {HASH8.format('row_id', 123)} % 10000 < 3300 as is_test,
         ((coalesce(sum_price, 0) > 100000) <> ({HASH8.format('row_id', 99)} % 100 < 20))::int as label,
         round(prob, 9) as prob, o_totalprice, coalesce(sum_price, 0)::double as sum_price
  from scored),
scores as (
  select 'gbt' as ml_name, is_test, label, sum_price as score from candidates
  union all select 'forest', is_test, label, prob from candidates
  union all select 'logistic', is_test, label, round(o_totalprice / 50000) from candidates),
ranked as (
  select ml_name, is_test, label, rank() over (partition by ml_name, is_test order by score)
           + (count(*) over (partition by ml_name, is_test, score) - 1) / 2.0::double as avg_rank
  from scores),
auc as (
  select ml_name, is_test, sum(label)::bigint as n_pos, sum(1 - label)::bigint as n_neg,
         (sum(case when label = 1 then avg_rank end) - sum(label) * (sum(label) + 1) / 2.0::double)
           / (sum(label)::double * sum(1 - label)) as auc
  from ranked group by all),
decay as (
  select ml_name, max(case when not is_test then auc end) as auc_train, max(case when is_test then auc end) as auc_test,
         (max(case when not is_test then auc end) - max(case when is_test then auc end))
           / max(case when not is_test then auc end) * 100 as decay_percent
  from auc group by ml_name)"""

TEXTS = """
texts as (
  select o_orderkey as row_id, case o_orderkey % 7 when 0 then '' when 1 then 'null' when 2 then 'None'
           else o_totalprice::varchar end as raw_value,
         o_totalprice from orders)"""
CUSTOMERS = """
customers as (select c_custkey, case when c_custkey % 13 <> 0 then c_mktsegment end as segment from customer)"""

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def sql() -> dict[str, str]:
    month_count = "select {0}::varchar as fmt, period, count(*) as n, round(sum(o_totalprice), 2) as total from o group by all"
    learners = """select unnest(['gbt', 'forest', 'logistic']) as ml_name, true as auc_in_bounds,
        true as decay_holds, true as timed"""
    orders_cte = "o as (select cast(year(o_orderdate) - 1994 as int) as period, o_orderpriority, o_totalprice from orders)"
    return {
        "scan_period_union": f"""with {orders_cte}
            select period, count(*) as n, count(case when period > 1 then o_orderpriority end) as n_priority,
                   round(sum(o_totalprice), 2) as total from o group by all""",
        "scan_csv_roundtrip": f"with {orders_cte} " + " union all ".join(
            month_count.format(f"'{fmt}'") for fmt in ("csv", "folder", "parquet")),
        "scan_folder_by_name": """select cast(year(o_orderdate) - 1994 as int) as period, count(*) as n,
            count(o_orderpriority) as n_priority,
            count(case when (year(o_orderdate) - 1994) % 3 = 2 then o_orderstatus end) as n_status,
            min(o_orderpriority) as first_priority, round(sum(o_totalprice), 2) as total from orders group by period""",
        "scan_quarantine": """select cast(year(o_orderdate) - 1994 as int) as period, count(*) filter (o_orderkey % 25 != 0) as n,
            round(max(case when o_orderkey % 25 != 0 then o_totalprice end), 2) as highest,
            count(*) filter (o_orderkey % 25 = 0) as n_rejected, count(*) filter (o_orderkey % 25 = 0) as n_torn
            from orders group by period""",
        "rerun_period": f"""with {SCORED} select period, count(*) as n, sum(row_id)::bigint as ids, round(max(prob), 6) as highest
            from scored where period = 6 or (period = 5 and row_id % 3 != 0) group by period""",
        "promotion_race": f"""with {CANDIDATES} select ml_name as name, is_test, n_pos, round(auc, 6) as auc,
            (select array_to_string(range(1, count(*) + 1), ',') from auc) as versions from auc""",
        "feature_tables": f"""with {SCORED} {"union all".join(f"""
            select '{name}' as name, period, count(*) as n, round(min({value}), 6) as low, round(max({value}), 6) as high
            from scored group by period """ for name, value in (
                ('features', 'coalesce(sum_qty::float, -9999999::float)::double'), ('post', 'monto::double'), ('scores', 'prob')))}""",
        "clean_null_tokens": f"""with {TEXTS}
            select row_id, case when raw_value not in ('', 'null', 'None') then o_totalprice::float::double end as value
            from texts""",
        "fill_sentinel": f"""with {BASE} select row_id, {', '.join(
            f"coalesce({c}::float, -9999999::float)::double as {c}" for c in NUMERIC)} from base""",
        "missing_counts": f"with {BASE} select period, {', '.join(f'count({c}) as {c}' for c in NUMERIC)} from base group by period",
        "collapse_category": f"""with {CUSTOMERS}
            select c_custkey, case when segment in ('BUILDING', 'MACHINERY') then segment else 'OTRO' end as segment
            from customers""",
        "one_hot_forced": f"""with {CUSTOMERS}
            select c_custkey, coalesce(segment = 'BUILDING', false) as segment_BUILDING,
                   coalesce(segment = 'OTRO', false) as segment_OTRO from customers""",
        "one_hot_discovered": f"""with {CUSTOMERS} select c_custkey, {', '.join(
            f"coalesce(segment = '{s}', false) as segment_{s}" for s in SEGMENTS)} from customers""",
        "project_features": f"with {PREPARED} select row_id, period, {', '.join(PREPARED_FEATURES)} from prepared",
        "project_post": f"""with {BASE}
            select row_id, period, codmes, key_value, codunicocli, grp, round(prob_value_contact, 6) as prob_value_contact,
                   monto from base""",
        "hash_split": f"select o_orderkey as row_id, {HASH8.format('o_orderkey', 123)} % 10000 < 3300 as is_test from orders",
        "exact_split": f"""select o_orderkey as row_id,
            row_number() over (order by {HASH13.format('o_orderkey', 123)}, o_orderkey)
              <= (select ceil(0.33::double * count(*)) from orders) as is_test from orders""",
        "normalise_types": """select l_orderkey::bigint as l_orderkey, l_linenumber::bigint as l_linenumber,
            (l_returnflag = 'R')::int as returned, round_even(l_extendedprice / 7, 4) as seventh,
            round_even(l_tax::float::double, 4) as l_tax from lineitem""",
        "align_columns": """select o_orderkey, o_totalprice, 0::int as brand_new, o_custkey from orders""",
        "quantile_edges": f"""with {BASE}, ranked as (
            select feature, value, row_number() over (partition by feature order by value) - 1 as place,
              count(*) over (partition by feature) as n
            from (unpivot (select {', '.join(f'{c}::double as {c}' for c in NUMERIC)} from base where {REF})
                  on {', '.join(NUMERIC)} into name feature value value)
            where value is not null and not isnan(value)
        ), wanted as (
            select feature, n, i, (i * (n - 1)) // 10 as k, ((i * (n - 1)) % 10) / 10.0::double as weight
            from (select distinct feature, n from ranked), (select unnest(range(1, 10)) as i))
        select w.feature, w.n, w.i::int as cut, round(lo.value + case when weight = 0 then 0 else (hi.value - lo.value) * weight end, 6) as edge
        from wanted w join ranked lo on lo.feature = w.feature and lo.place = w.k
        left join ranked hi on hi.feature = w.feature and hi.place = w.k + 1""",
        "drift_bins": f"""{RAW} select g.period, g.feature, g.bin::int as bin, round(lo.edge, 6) as lo, round(hi.edge, 6) as hi,
            round(r, 6) as ref_share, round(a, 6) as act_share, round((r - a) * ln(r / a), 6) as psi_term,
            round(r * ln(r / a), 6) as kl_term
            from d_shares g left join d_edges lo on lo.feature = g.feature and lo.i = g.bin
            left join d_edges hi on hi.feature = g.feature and hi.i = g.bin + 1""",
        "psi_report_raw": f"""{RAW} select period, feature, n_ref, n_actual, round_even(psi, 5) as psi,
            {BAND.format('round_even(psi, 5)')} as status from d_psi where {ENOUGH}""",
        "psi_report_q1000": f"""with {BASE}, {sides('d', 'base', NUMERIC, 1000)}
            select period, feature, n_ref, n_actual, round_even(psi, 5) as psi from d_psi where {ENOUGH}""",
        "psi_report_pre": f"""with {PREPARED}, {sides('d', 'prepared', PREPARED_FEATURES, 10)}
            select period, feature, n_ref, n_actual, round_even(psi, 5) as psi from d_psi where {ENOUGH}""",
        "kl_report": f"{RAW} select period, feature, round(kl, 6) as metric_value from d_psi",
        "psi_q1000_ties": f"{TIES} select period, feature, n_ref, n_actual, round_even(psi, 5) as psi from d_psi where {ENOUGH}",
        "score_drift": f"""with {SHIFTED}, {sides('d', 'shifted', ['predictions'], 10, ref='period = 1')}
            select period, feature, n_ref, n_actual, round_even(psi, 5) as psi from d_psi where {ENOUGH}""",
        "group_drift": f"{GROUP} select period, grupo_ejec, columna, psi, n_actual from group_report",
        "reference_self_check": self_check(),
        "stage_summary": all_stages(),
        "stage_run_records": f"""{RAW}
            select 'raw' as stage, period::int as period, true as timed, 0.0::double as ram_delta_mb,
                   round(avg(round_even(psi, 5)), 6) as psi_medio from d_psi where {ENOUGH} group by period
            union all select 'score', p::int, true, 0.0::double, null from (select unnest([5, 6]) as p)""",
        "stored_run": f"""{RAW},
            record as (select period::int as period, count(*) as report_rows, sum(n_actual)::bigint as values_compared,
                              round(avg(round_even(psi, 5)), 6) as psi_medio, max(round_even(psi, 5)) as worst
                       from d_psi where {ENOUGH} group by period)
            select 'run-1' as run_id, '2024-01-31 08:30' as at, 'raw' as stage, period, false as failed, report_rows,
                   values_compared, psi_medio, psi_medio as value, worst from record
            union all select 'run-1', '2024-01-31 08:30', 'score', p::int, true, 0::bigint, 0::bigint, null, null, null
            from (select unnest([5, 6]) as p)""",
        "training_phase": phase("period = 1", "period between 2 and 4", "select unnest(['score', 'grupo']), 1, 0.0::double"),
        "monitoring_phase": phase(REF, ACT, """select stage, period, null::double
            from (select unnest(['score', 'grupo']) as stage), (select unnest([5, 6]) as period)"""),
        "train_candidates": learners, "hpo_search": learners,
        "batch_inference": f"with {BASE} select row_id, period, true as is_probability from base",
        "model_registry": """select 'extrac' as model_name, folder, version, 'produccion' as stage, true as auc_in_bounds
            from (values ('2024-01-01_00-00-00', 1), ('2024-01-02_00-00-00', 2)) as v(folder, version)""",
        "rolling_psi": f"""with {RUNS}, {rolled('history')}
            select stage, period, round(rolling_psi, 6) as rolling_psi from rolled""",
        "run_summary": f"""with {RUNS} select stage, period, {BAND.format('psi_medio')} as status, psi_medio
            from history where psi_medio is not null""",
        "value_score": f"with {VALUED} select row_id, period, round(puntuacion, 6) as puntuacion from valued",
        "exec_groups": f"with {GROUPED} select row_id, period, grupo_ejec from grouped",
        "dedup_best": f"with {DELIVERED} select period, key_value, row_id from best",
        "order_rank": f"""with {VALUED} select row_id, period, (row_number() over (
            partition by period order by puntuacion desc nulls last, row_id))::int as orden from valued""",
        "delivery_file": f"""with {DELIVERED} select period, codmes, tipdoc, coddoc, round(puntuacion, 6) as puntuacion,
            modelo, fec_replica, grupo_ejec, round(score, 6) as score, orden, variable1, variable2, variable3 from delivered""",
        "delivery_roundtrip": f"""with {DELIVERED} select period, codmes, coddoc::varchar as coddoc, grupo_ejec,
            round(score, 6) as score, orden, variable1, variable2 from delivered""",
        "psi_matrix_topn": f"""{RAW}, m as (
            select feature, max(case when period = 5 then round_even(psi, 5) else 0 end) as p5,
                   max(case when period = 6 then round_even(psi, 5) else 0 end) as p6
            from d_psi where {ENOUGH} group by feature)
            select feature, p5, p6 from m order by greatest(p5, p6) desc, feature limit 5""",
        "score_density": f"""with {SCORED},
            spans as (select period, min(prob) as a, max(prob) as b, count(*) as n from scored group by period),
            grid as (select *, (b - a) / 40 as width from spans, (select unnest(generate_series(0, 39))::int as bin)),
            counted as (select s.period, least(floor((prob - a) / (b - a) * 40), 39)::int as bin, count(*) as k
                        from scored s join spans p on p.period = s.period group by all)
            select g.period, g.bin, round(a + g.bin * width, 6) as lo, round(a + (g.bin + 1) * width, 6) as hi,
                   coalesce(k, 0) as n, round(coalesce(k, 0) / (g.n * width), 6) as density
            from grid g left join counted c on c.period = g.period and c.bin = g.bin""",
        "stage_period_grid": f"""with {RUNS}, {GRID}, {rolled('dense')}
            select stage, period, coalesce(psi_medio, 0.0::double) as psi_medio,
                   case when stage = 'score' then round(rolling_psi, 6) end as rolling_psi from rolled""",
        "group_matrix": f"""{GROUP} select grupo_ejec, max(case when period = 5 then psi else 0 end) as p5,
            max(case when period = 6 then psi else 0 end) as p6
            from group_report where columna = 'score' group by grupo_ejec""",
        "traffic_light": f"""with {RUNS}, {GRID}, wide as (select period, {', '.join(
            f"max(case when stage = '{s}' then psi_medio end) as {s}" for s in ('raw', 'pre', 'score', 'grupo'))}
            from dense group by period)
            select period, {', '.join(f"{LIGHT.format(s)} as {s}" for s in ('raw', 'pre', 'score', 'grupo'))} from wide""",
        "ops_timeline": f"""with {RUNS} select r.stage, r.period, duration_s, 0.0::double as ram_proc_mb, ram_delta_mb,
            0.0::double as cpu_pct, ram_sys_pct, 0.0::double as ram_sys_mb, h.psi_medio
            from runs r left join history h on h.stage = r.stage and h.period = r.period""",
        "ops_alerts": f"""with {RUNS}
            select 1::int as kind_no, stage, period, printf('LENTO  [%s p%d]: %.1fs > umbral 30.0s', stage, period,
                   round_even(duration_s, 1)) as message from runs where duration_s > 30
            union all select 2::int, stage, period, printf('RAM+   [%s p%d]: +%.0fMB > umbral 200.0MB', stage, period,
                   round_even(ram_delta_mb, 0)) from runs where ram_delta_mb > 200
            union all select 3::int, stage, period, printf('SYSRAM [%s p%d]: Sistema al %.0f%% RAM > umbral 80.0%%', stage,
                   period, round_even(ram_sys_pct, 0)) from runs where ram_sys_pct > 80""",
        "ops_first_alerts": f"""with {RUNS}, alerts as (
            select 1::int as kind_no, stage, period from runs where duration_s > 30
            union all select 2::int, stage, period from runs where ram_delta_mb > 200
            union all select 3::int, stage, period from runs where ram_sys_pct > 80)
            select * from alerts order by kind_no, case stage when 'raw' then 1 when 'pre' then 2 when 'score' then 3
              when 'grupo' then 4 end, period limit 4""",
        "ops_duration_pivot": f"""with {RUNS} select period, {', '.join(
            f"max(case when stage = '{s}' then duration_s else 0 end) as {s}" for s in ('raw', 'pre', 'score', 'grupo'))},
            round(avg(ram_sys_pct), 6) as ram_sys_pct from runs group by period""",
        "ops_ram_pivot": f"""with {RUNS} select stage, {', '.join(
            f"avg(case when period = {p} then ram_delta_mb end) as p{p}" for p in range(1, 31))} from runs group by stage""",
        "metric_history": f"""with {RUNS} select 'run-1' as run_id, printf('psi_%s_p%d', stage, period) as name,
            psi_medio as value from history where psi_medio is not null""",
        "latest_model": """select strftime(max(ts), '%Y-%m-%d_%H-%M-%S') as folder from events
            where event_type <> 'error'""",
        "roc_auc": f"with {CANDIDATES} select ml_name, is_test, n_pos, n_neg, round(auc, 6) as auc from auc",
        "auc_decay": f"""with {CANDIDATES} select ml_name, round(auc_train, 6) as auc_train, round(auc_test, 6) as auc_test,
            round(decay_percent, 6) as decay_percent from decay""",
        "champion": f"""with {CANDIDATES} select ml_name, round(auc_test, 6) as auc_test from decay where decay_percent < 10
            order by decay.auc_test desc, list_position(['gbt', 'forest', 'logistic'], ml_name) limit 1""",
    }
