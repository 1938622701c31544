"""Every operator as a named query over the test tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickweave.functions.names import flat_db_part, has_token, label_number, table_of_file, trailing_number
from tickweave.operators import audit, distribution, levels, numbering, quantiles, selecting, sensitivity, series, shaping
from tickweave.operators.params import parameter_domain, set_spine, with_params
from tickweave.operators.per_run import per_run
from tickweave.plans import jobs
from tickweave.plans.testtables import (
    ENS_SQL, PARAMS_SQL, TIE, once, archives, databases, ens, params, run_tree, snapshot_files, snapshots_xml, table,
)
from tickweave.plans.views import run_analysis, run_views
from tickweave.session import scratch_path, settle
from tickweave.sinks.feather import write_feather
from tickweave.sinks.run_files import mirror_tables, write_run_files
from tickweave.sinks.tables import compact, materialize, new_files, remember_files, write_checkpoint, write_metric_checkpoints
from tickweave.sources.feather import read_feather
from tickweave.sources.footers import excluded_tables, schema_manifest, table_files
from tickweave.sources.params import read_params
from tickweave.sources.sqlite_db import ingest_sqlite_tree
from tickweave.sources.tar import read_tar_tree
from tickweave.sources.tree import read_metric, read_metric_ledgered, read_snapshot_tree, read_snapshots, read_tree, resolve_agent
from tickweave.sources.xml_states import read_xml_snapshots
from tickweave.streaming.incremental import ingest_new, keep_band, read_band, stream_tree

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SETS = [1, 2, 3, 4, 5, 6, 7]
EVERY_TICK = {"start": 61, "stop": 143, "step": 1}
COORD = '"ID", part, run_num, set_num, time_step'


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL to compare it to."""

    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return keep


def with_ens(body: str, **more: str) -> str:
    tables = {"ens": ENS_SQL, **more}
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in tables.items()) + " " + body


def rounded(df: DataFrame, *cols: str, places: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in cols})


def singles(df: DataFrame, *cols: str) -> DataFrame:
    """Interpolated values may differ in the last bit between engines; single precision hides that."""
    return df.withColumns({c: F.col(c).cast("float") for c in cols})


def wide(df: DataFrame) -> DataFrame:
    """Coordinates as bigint and metrics as double, the same on both engines."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            F.col(f"`{c}`").cast("bigint").alias(c) if isinstance(t, T.IntegralType)
            else F.col(f"`{c}`").cast("double").alias(c) if isinstance(t, (T.FloatType, T.DoubleType)) else F.col(f"`{c}`")
            for c, t in kinds.items()
        ]
    )


def big(*cols: str) -> str:
    return ", ".join(f'CAST("{c}" AS BIGINT) AS "{c}"' for c in cols)


def dbl(*cols: str) -> str:
    return ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in cols)


ENS_ROWS = with_ens(f'SELECT {big("set_num", "run_num", "time_step", "ID", "part")}, {dbl("x", "y", "price")} FROM ens')


# ---- time series and scatter views


BAND_SQL = """SELECT CAST(set_num AS BIGINT) AS set_num, CAST(time_step AS BIGINT) AS iteration, avg(x) AS mean_val,
  CAST(min(x) AS DOUBLE) AS min_val, CAST(max(x) AS DOUBLE) AS max_val FROM ens GROUP BY set_num, time_step"""


@query(with_ens(BAND_SQL + " ORDER BY set_num, iteration"))
def time_series_band(spark, sf):
    return wide(series.time_series(ens(spark, sf), "x", SETS))


@query(with_ens(f'SELECT {big("set_num")}, CAST(time_step AS BIGINT) AS iteration, CAST(x AS DOUBLE) AS x_val, CAST(y AS DOUBLE) AS y_val FROM ens'))
def scatter_xy(spark, sf):
    return wide(series.scatter(ens(spark, sf), "x", "y", SETS, EVERY_TICK))


@query(with_ens(f"SELECT {big('set_num')}, CAST(time_step AS BIGINT) AS iteration, CAST(x AS DOUBLE) AS target_value FROM ens WHERE time_step BETWEEN 61 AND 143 AND (time_step - 61) % 6 = 0"))
def snapshot_values(spark, sf):
    return wide(series.snapshot(ens(spark, sf), "x", SETS, {"start": 61, "stop": 143, "step": 6}))


DELAY_SQL = """SELECT * FROM (SELECT set_num, iteration, current_val, lag(current_val, 2) OVER (PARTITION BY set_num ORDER BY iteration) AS lagged_val
  FROM (SELECT CAST(set_num AS BIGINT) AS set_num, CAST(time_step AS BIGINT) AS iteration, avg(x) AS current_val FROM ens GROUP BY ALL)) WHERE lagged_val IS NOT NULL"""


@query(with_ens(f"SELECT set_num, iteration, current_val, lagged_val FROM ({DELAY_SQL})"))
def delay_lag(spark, sf):
    return wide(series.delay(ens(spark, sf), "x", SETS, 2))


@query(with_ens(
    "SELECT set_num, iteration, current_val, lagged_val FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY set_num ORDER BY iteration DESC) AS back FROM ({DELAY_SQL})) WHERE back <= 2"
))
def delay_tail(spark, sf):
    return wide(series.delay_tail(series.delay(ens(spark, sf), "x", SETS, 2)))


@query(with_ens(f'SELECT {big("set_num", "run_num")}, CAST(arg_max(x, row(time_step, "ID", part, price)) AS DOUBLE) AS last_val FROM ens GROUP BY set_num, run_num'))
def run_terminal_value(spark, sf):
    return wide(series.last_value(ens(spark, sf), "x", order=("time_step", "ID", *TIE)))


# ---- distributions


def edge_sql(lo: str, hi: str, i: str, bins: int) -> str:
    return f"CASE WHEN {i} = {bins} THEN {hi} ELSE {lo} + {i} * (({hi} - {lo}) / {bins}) END"


def bin_sql(v: str, lo: str, hi: str, bins: int) -> str:
    """Bin of a value by comparing it with every inner edge."""
    return f"len(list_filter(range(1, {bins}), lambda i: {v} >= {lo} + i * (({hi} - {lo}) / {bins})))"


def histogram_sql(rows: str, keys: str, v: str, bins: int) -> str:
    on = " AND ".join(f"b.{k} = c.{k}" for k in keys.split(", "))
    of_b = ", ".join(f"b.{k}" for k in keys.split(", "))
    return f"""rows_ AS ({rows}), ends AS (SELECT {keys}, min(CAST({v} AS DOUBLE)) AS a, max(CAST({v} AS DOUBLE)) AS z FROM rows_ GROUP BY {keys}),
  bounds AS (SELECT {keys}, CASE WHEN a = z THEN a - 0.5 ELSE a END AS lo, CASE WHEN a = z THEN z + 0.5 ELSE z END AS hi FROM ends),
  counts AS (SELECT {of_b}, {bin_sql(f"CAST({v} AS DOUBLE)", "lo", "hi", bins)} AS bin, count(*) AS n
    FROM rows_ c JOIN bounds b ON {on} GROUP BY ALL)
  SELECT {of_b}, g.bin, {edge_sql("lo", "hi", "g.bin", bins)} AS bin_lo, {edge_sql("lo", "hi", "(g.bin + 1)", bins)} AS bin_hi, coalesce(c.n, 0) AS n
  FROM bounds b CROSS JOIN (SELECT unnest(generate_series(0, {bins - 1})) AS bin) g LEFT JOIN counts c ON {on} AND c.bin = g.bin"""


SNAPSHOT_SQL = "SELECT CAST(set_num AS BIGINT) AS set_num, CAST(time_step AS BIGINT) AS iteration, x AS target_value FROM ens"


@query(f"WITH ens AS ({ENS_SQL}), " + histogram_sql(SNAPSHOT_SQL, "iteration, set_num", "target_value", 30))
def histogram_30(spark, sf):
    rows = series.snapshot(ens(spark, sf), "x", SETS, EVERY_TICK)
    h = distribution.histogram(rows, "target_value", at_most_groups=distribution.most_groups(SETS, EVERY_TICK))
    return wide(h)


@query(f"WITH ens AS ({ENS_SQL}), " + histogram_sql("SELECT CAST(set_num AS BIGINT) AS set_num, avg(x) AS x FROM ens GROUP BY set_num, run_num, time_step", "set_num", "x", 50))
def histogram_of_means(spark, sf):
    means = levels.analyze(ens(spark, sf), "x", "multiple_run", "mean")
    return wide(distribution.histogram(means, "x", ["set_num"], 50))


@query("WITH " + histogram_sql("SELECT l_linenumber, l_discount FROM lineitem", "l_linenumber", "l_discount", 10))
def histogram_decimal(spark, sf):
    return wide(distribution.histogram(table(spark, sf, "lineitem"), "l_discount", ["l_linenumber"], 10))


def box_sql(rows: str, keys: str, v: str) -> str:
    on = " AND ".join(f"q.{k} = r.{k}" for k in keys.split(", "))
    return f"""rows_ AS ({rows}), q AS (SELECT {keys}, count(*) AS n, quantile_cont(CAST({v} AS DOUBLE), 0.25) AS q1,
    quantile_cont(CAST({v} AS DOUBLE), 0.5) AS median, quantile_cont(CAST({v} AS DOUBLE), 0.75) AS q3 FROM rows_ GROUP BY {keys}),
  f AS (SELECT r.{v} AS v, q.*, v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) AS inside FROM rows_ r JOIN q ON {on})
  """


@query(f"WITH ens AS ({ENS_SQL}), " + box_sql(SNAPSHOT_SQL, "iteration, set_num", "target_value") + """
  SELECT iteration, set_num, n, q1, median, q3,
    least(q1, min(CASE WHEN inside THEN CAST(v AS DOUBLE) END)) AS whisker_lo,
    greatest(q3, max(CASE WHEN inside THEN CAST(v AS DOUBLE) END)) AS whisker_hi,
    count(*) FILTER (WHERE NOT inside) AS n_outliers FROM f GROUP BY iteration, set_num, n, q1, median, q3""")
def box_stats(spark, sf):
    rows = series.snapshot(ens(spark, sf), "x", SETS, EVERY_TICK)
    b = distribution.box_stats(rows, "target_value", at_most_groups=distribution.most_groups(SETS, EVERY_TICK))
    return wide(b)


EVENT_SQL = "SELECT event_type, value FROM events"


@query("WITH " + box_sql(EVENT_SQL, "event_type", "value").rstrip() + " SELECT event_type, v AS outlier FROM f WHERE NOT inside")
def box_outliers(spark, sf):
    return distribution.box_outliers(table(spark, sf, "events"), "value", ["event_type"])


@query("WITH " + box_sql(EVENT_SQL, "event_type", "value").rstrip()
       + " SELECT event_type, count(*) AS n, round(sum(v), 2) AS total FROM f WHERE inside GROUP BY event_type")
def outliers_stripped(spark, sf):
    kept = selecting.strip_outliers(table(spark, sf, "events").select("event_type", "value"), "value", ["event_type"])
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


# ---- levels of the hierarchy


@query(with_ens(f'SELECT {big("set_num", "run_num", "time_step")}, avg(x) AS x, avg(y) AS y FROM ens GROUP BY set_num, run_num, time_step'))
def level_mean_run(spark, sf):
    return wide(levels.analyze(ens(spark, sf), ["x", "y"], "multiple_run"))


@query(with_ens(f'SELECT {big("set_num", "time_step")}, avg(x) AS x FROM ens GROUP BY set_num, time_step'))
def level_mean_batch(spark, sf):
    return wide(levels.analyze(ens(spark, sf), "x", "multiple_batch"))


@query(with_ens(f'SELECT {big("time_step")}, avg(x) AS x FROM ens GROUP BY time_step'))
def level_mean_set(spark, sf):
    return wide(levels.analyze(ens(spark, sf), "x", "multiple_set"))


@query(with_ens(f'SELECT {big("set_num", "run_num", "time_step", "ID")}, avg(x) AS x FROM ens GROUP BY set_num, run_num, time_step, "ID"'))
def level_mean_agent(spark, sf):
    return wide(levels.analyze(ens(spark, sf), "x", "agent"))


@query(with_ens(f"""SELECT CASE WHEN grouping(set_num) = 1 THEN 'multiple_set' WHEN grouping(run_num) = 1 THEN 'multiple_batch'
  WHEN grouping("ID") = 1 THEN 'multiple_run' ELSE 'agent' END AS level, {big("set_num", "run_num", "time_step", "ID")}, avg(x) AS mean_val, count(x) AS n
  FROM ens GROUP BY GROUPING SETS ((set_num, run_num, time_step, "ID"), (set_num, run_num, time_step), (set_num, time_step), (time_step))"""))
def level_grouping_sets(spark, sf):
    return wide(levels.analyze_all(ens(spark, sf), "x"))


@query(with_ens(f'SELECT {big("set_num", "time_step")}, {dbl("x")} FROM ens'))
def level_full(spark, sf):
    return wide(levels.analyze(ens(spark, sf), "x", "multiple_batch", "full"))


@query(with_ens(f"""SELECT {big("set_num", "time_step")}, count(x) AS n, CAST(CAST(quantile_cont(CAST(x AS DOUBLE), 0.2) AS FLOAT) AS DOUBLE) AS q_lo,
  CAST(CAST(quantile_cont(CAST(x AS DOUBLE), 0.5) AS FLOAT) AS DOUBLE) AS q_mid, CAST(CAST(quantile_cont(CAST(x AS DOUBLE), 0.8) AS FLOAT) AS DOUBLE) AS q_hi FROM ens GROUP BY set_num, time_step"""))
def quantile_band(spark, sf):
    return wide(singles(levels.analyze(ens(spark, sf), "x", "multiple_batch", "custom_quantile", 0.2, 0.8), "q_lo", "q_mid", "q_hi"))


@query(with_ens(
    f'SELECT {big("set_num", "run_num", "time_step", "ID", "part")}, {dbl("x", "y", "price")} FROM ens JOIN q USING (set_num, time_step) WHERE CAST(x AS DOUBLE) BETWEEN lo AND hi',
    q="SELECT set_num, time_step, quantile_cont(CAST(x AS DOUBLE), 0.9) AS lo, max(CAST(x AS DOUBLE)) AS hi FROM ens GROUP BY ALL",
))
def quantile_subset(spark, sf):
    return wide(selecting.quantile_subset(ens(spark, sf), "x", 0.9, 1.0))


@query(with_ens(f'SELECT {big("set_num", "time_step")}, avg(x) AS x_mean, avg(y) AS y_mean FROM ens GROUP BY set_num, time_step'))
def scatter_level_mean(spark, sf):
    return wide(levels.analyze_xy(ens(spark, sf), "x", "y", "multiple_batch"))


# ---- filters


@query(with_ens(
    f"""SELECT {big("set_num", "run_num", "time_step", "ID", "part")}, {dbl("x", "y", "price")} FROM
  (SELECT *, dense_rank() OVER (PARTITION BY set_num, run_num ORDER BY "ID") - 1 AS place FROM ens WHERE set_num BETWEEN 1 AND 6 AND run_num IN (1, 2, 5, 9))
  WHERE place BETWEEN 10 AND 90 AND (place - 10) % 4 = 0 AND time_step BETWEEN 61 AND 143 AND (time_step - 61) % 2 = 0"""))
def hierarchy_slice(spark, sf):
    return wide(selecting.slice_ens(
        ens(spark, sf), set=["range", [1, 6]], run=[1, 2, 5, 9], major=["range", [61, 143, 2]], minor=["range", [10, 90, 4]], minor_is="position"
    ))


@query(with_ens(f'SELECT {big("set_num", "run_num", "time_step", "ID", "part")}, {dbl("x", "y", "price")} FROM ens WHERE set_num BETWEEN 2 AND 5 AND run_num BETWEEN 3 AND 8'))
def range_filter(spark, sf):
    return wide(selecting.in_ranges(ens(spark, sf), "2-5", "3-8"))


HOUR_SQL = "CAST(floor(epoch(ts) / 3600) AS BIGINT)"


def _hour_events(spark, sf):
    day = F.unix_date(F.col("ts").cast("date")).cast("bigint")
    return table(spark, sf, "events").withColumn("tick", day * 24 + F.hour("ts"))


@query(f"SELECT event_id, user_id, tick FROM (SELECT *, {HOUR_SQL} AS tick FROM events) WHERE tick % 6 = 2")
def period_phase(spark, sf):
    return selecting.every(_hour_events(spark, sf), 6, 2, "tick").select("event_id", "user_id", "tick")


STRIDE_SQL = f'SELECT *, row_number() OVER (PARTITION BY set_num, run_num ORDER BY time_step, "ID", part, price) - 1 AS pos FROM ens'


@query(with_ens(f'SELECT {big("set_num", "run_num", "time_step", "ID", "part")}, {dbl("x", "y", "price")}, pos // 5 + 1 AS ordinal FROM ({STRIDE_SQL}) WHERE pos % 5 = 0'))
def stride_ordinal(spark, sf):
    return wide(selecting.strided(ens(spark, sf), 5, tie=TIE))


@query("""SELECT event_type, user_id, props, event_id, pos // 7 + 1 AS ordinal FROM
  (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY props NULLS FIRST, event_id) - 1 AS pos FROM events) WHERE pos % 7 = 0""")
def stride_text_id(spark, sf):
    """Positions under a text order, with few and hot groups."""
    rows = table(spark, sf, "events").select("event_type", "user_id", "props", "event_id")
    return wide(selecting.strided(rows, 7, ["event_type"], ["props", "event_id"]))


@query(with_ens(f'SELECT {big("set_num", "run_num", "time_step", "part")}, {dbl("x", "y", "price")}, pos AS "ID" FROM ({STRIDE_SQL.replace(chr(34) + "ID" + chr(34) + ", ", "")})'))
def surrogate_id(spark, sf):
    rows = ens(spark, sf).drop("ID")
    numbered = numbering.with_position(rows, ["set_num", "run_num"], ["time_step"], TIE, "_pos")
    return wide(numbered.withColumn("ID", F.col("_pos") - 1).drop("_pos"))


@query(with_ens(f'SELECT {big("set_num", "run_num", "time_step", "ID", "part")}, {dbl("x", "y", "price")} FROM ens WHERE x >= 0 AND CAST(x AS DOUBLE) <= (SELECT quantile_cont(CAST(x AS DOUBLE), 0.95) FROM ens)'))
def percentile_clip(spark, sf):
    rows = ens(spark, sf)
    return wide(selecting.clip_window(rows, "x", sensitivity.threshold(rows, "x", 95)))


@query(with_ens("SELECT least(5000, count(*)) AS n, least(5000, count(*)) AS in_source, least(5000, count(*)) AS drawn_again FROM ens"))
def capped_points(spark, sf):
    """The sample's size, how many of its rows the table has (copies counted), and how many another draw brings again."""
    rows = ens(spark, sf)
    one, two = selecting.cap_points(rows, 5_000), selecting.cap_points(rows, 5_000)
    size = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return size(one, "n").join(size(one.intersectAll(rows), "in_source")).join(size(one.intersectAll(two), "drawn_again"))


@query(with_ens("SELECT CAST(set_num AS BIGINT) AS set_num, count(x) AS n, p, true AS within FROM ens, (SELECT unnest([0.2, 0.5, 0.8])::DOUBLE AS p) GROUP BY ALL"))
def quantiles_approximate(spark, sf):
    """Whether the ranks of each picked value, counted over all rows, are as near to the wanted one as promised."""
    rows, probs, accuracy = ens(spark, sf), [0.2, 0.5, 0.8], 1_000
    picked = quantiles.approx_quantiles(rows, "x", {f"q{i}": p for i, p in enumerate(probs)}, ["set_num"], accuracy)
    v = F.col("x").cast("double")
    ranks = [F.count_if(c).alias(f"{n}{i}") for i in range(len(probs)) for n, c in (("below", v < F.col(f"q{i}")), ("upto", v <= F.col(f"q{i}")))]
    counted = rows.join(picked, "set_num").groupBy("set_num", "n").agg(*ranks)
    room = F.col("n") / accuracy + 1
    each = [F.struct(F.lit(p).alias("p"), ((F.col(f"below{i}") <= p * F.col("n") + room) & (F.col(f"upto{i}") >= p * F.col("n") - room)).alias("within")) for i, p in enumerate(probs)]
    return wide(counted.select("set_num", "n", F.inline(F.array(*each))))


@query("SELECT count(*) AS n, count(customer_value) AS kept, round(sum(CASE WHEN customer_value IS NOT NULL THEN customer_value END), 2) AS total FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS customer_value FROM orders) WHERE customer_value IS NOT NULL")
def missing_dropped(spark, sf):
    v = F.when(F.col("o_orderstatus") == "P", F.when(F.col("o_orderkey") % 2 == 0, F.lit(float("nan")))).otherwise(F.col("o_totalprice"))
    kept = selecting.drop_missing(table(spark, sf, "orders").select(v.alias("customer_value")))
    return kept.agg(F.count(F.lit(1)).alias("n"), F.count("customer_value").alias("kept"), F.round(F.sum("customer_value"), 2).alias("total"))


# ---- parameters, density, sensitivity


def _params_csv(spark, sf) -> str:
    path = scratch_path(spark, "params")
    labelled = params(spark, sf).withColumn("set_num", F.concat(F.lit("set_"), F.col("set_num").cast("string")))
    labelled.write.option("header", "true").csv(path)
    return path


@query(f"SELECT CAST(set_num AS BIGINT) AS set_num, alpha, beta, gamma FROM ({PARAMS_SQL})")
def param_table(spark, sf):
    return wide(read_params(spark, _params_csv(spark, sf)))


@query(with_ens(f'SELECT {big("set_num", "run_num", "time_step", "ID", "part")}, {dbl("x")}, alpha, beta, gamma FROM ens LEFT JOIN (SELECT * FROM params WHERE set_num <> 4) USING (set_num)', params=PARAMS_SQL))
def param_join(spark, sf):
    known = params(spark, sf).where(F.col("set_num") != 4)
    return wide(with_params(ens(spark, sf).drop("y", "price"), known))


@query(f"SELECT s.set_num, alpha, beta FROM (SELECT unnest(generate_series(1, 14)) AS set_num) s LEFT JOIN (SELECT set_num * 2 AS set_num, alpha, beta FROM ({PARAMS_SQL})) p ON s.set_num = p.set_num")
def set_spine_gaps(spark, sf):
    sparse = params(spark, sf).select((F.col("set_num") * 2).alias("set_num"), "alpha", "beta")
    return wide(set_spine(sparse))


@query("WITH p AS (" + PARAMS_SQL + ") " + " UNION ALL ".join(
    f"SELECT '{n}' AS param, round(min(CAST(CAST({n} AS FLOAT) AS DOUBLE)), 6) AS x_min, round(max(CAST(CAST({n} AS FLOAT) AS DOUBLE)), 6) AS x_max FROM p" for n in ("alpha", "beta", "gamma")))
def param_domain(spark, sf):
    return rounded(parameter_domain(params(spark, sf)), "x_min", "x_max", places=6)


def _single_param(n: str) -> str:
    return f"SELECT set_num, '{n}' AS param, CAST(CAST({n} AS FLOAT) AS DOUBLE) AS v FROM params"


LONG_PARAMS = " UNION ALL ".join(_single_param(n) for n in ("alpha", "beta", "gamma"))


@query(with_ens(
    f"""SELECT param, x_bin, y_bin, any_value({edge_sql("lo", "hi", "x_bin", 500)}) AS x_lo, CAST(CAST(any_value({edge_sql("0.0", "top", "y_bin", 500)}) AS FLOAT) AS DOUBLE) AS y_lo, count(*) AS n
  FROM (SELECT set_num, top, {bin_sql("CAST(x AS DOUBLE)", "0.0", "top", 500)} AS y_bin FROM ens, thr WHERE x >= 0 AND CAST(x AS DOUBLE) <= top) JOIN cells USING (set_num) GROUP BY ALL""",
    params=PARAMS_SQL, long_=LONG_PARAMS, thr="SELECT quantile_cont(CAST(x AS DOUBLE), 0.99) AS top FROM ens",
    ends="SELECT param, min(v) AS lo, max(v) AS hi FROM long_ GROUP BY param",
    cells=f"SELECT set_num, param, lo, hi, CASE WHEN lo = hi THEN 499 ELSE {bin_sql('v', 'lo', 'hi', 500)} END AS x_bin FROM long_ JOIN ends USING (param)",
))
def density_2d(spark, sf):
    rows = ens(spark, sf)
    grid = sensitivity.density2d(rows, params(spark, sf), "x", 500, 99)
    return wide(singles(grid, "y_lo"))


@query(with_ens(
    f"""SELECT param, x_bin, y_bin, count(*) AS n, round(log10(count(*)), 9) AS log_n
  FROM (SELECT set_num, {bin_sql("CAST(x AS DOUBLE)", "0.0", "top", 40)} AS y_bin FROM ens, thr WHERE x >= 0 AND CAST(x AS DOUBLE) <= top) JOIN cells USING (set_num) GROUP BY ALL""",
    params=PARAMS_SQL, long_=LONG_PARAMS, thr="SELECT max(CAST(x AS DOUBLE)) AS top FROM ens",
    ends="SELECT param, min(v) AS lo, max(v) AS hi FROM long_ GROUP BY param",
    cells=f"SELECT set_num, param, CASE WHEN lo = hi THEN 39 ELSE {bin_sql('v', 'lo', 'hi', 40)} END AS x_bin FROM long_ JOIN ends USING (param)",
))
def log_counts(spark, sf):
    """The colour scale of a density picture."""
    grid = sensitivity.density2d(ens(spark, sf), params(spark, sf), "x", 40)
    return wide(rounded(sensitivity.log_counts(grid).select("param", "x_bin", "y_bin", "n", "log_n"), "log_n", places=9))


CIRCLE_STEP, CIRCLE_TURN = "0.01", "6.283185307"


@query(with_ens(f"""SELECT {big("set_num", "run_num", "time_step")}, count(*) AS n, round(any_value(set_num * cos(s)), 9) AS x, round(any_value(set_num * sin(s)), 9) AS y
  FROM (SELECT *, fmod(CAST(time_step AS DOUBLE) * CAST({CIRCLE_STEP} AS DOUBLE) * 12, CAST({CIRCLE_TURN} AS DOUBLE)) AS s FROM ens) GROUP BY set_num, run_num, time_step"""))
def circle_positions(spark, sf):
    """Places on a circle round the agent after the tick's share of a turn; the set number is the radius."""
    s = (F.col("time_step").cast("double") * F.lit(float(CIRCLE_STEP)) * F.lit(12)) % F.lit(float(CIRCLE_TURN))
    placed = ens(spark, sf).withColumns({"cx": F.col("set_num") * F.cos(s), "cy": F.col("set_num") * F.sin(s)})
    met = placed.groupBy("set_num", "run_num", "time_step").agg(F.count(F.lit(1)).alias("n"), F.max("cx").alias("x"), F.max("cy").alias("y"))
    return wide(rounded(met, "x", "y", places=9))


@query(with_ens(
    """SELECT param, count(DISTINCT x_bin) AS bins_used, count(*) AS rows, round(var_pop_of_bins / any_value(vt), 6) AS s1 FROM
  (SELECT *, (SELECT var_pop(CAST(x AS DOUBLE)) FROM ens) AS vt, var_pop(bin_mean) OVER (PARTITION BY param) AS var_pop_of_bins FROM
    (SELECT param, x_bin, avg(CAST(x AS DOUBLE)) OVER (PARTITION BY param, x_bin) AS bin_mean FROM ens JOIN cells USING (set_num))) GROUP BY param, var_pop_of_bins""",
    params=PARAMS_SQL, long_=LONG_PARAMS,
    ends="SELECT param, min(v) AS lo, max(v) AS hi FROM long_ GROUP BY param",
    cells=f"SELECT set_num, param, CASE WHEN lo = hi THEN 9 ELSE {bin_sql('v', 'lo', 'hi', 10)} END AS x_bin FROM long_ JOIN ends USING (param)",
))
def sensitivity_first_order(spark, sf):
    return wide(rounded(sensitivity.first_order(ens(spark, sf), params(spark, sf), "x", 10), "s1", places=6))


# ---- audit


@query(with_ens('SELECT CAST(set_num AS BIGINT) AS set_num, CAST(min(time_step) AS BIGINT) AS min_tick, CAST(max(time_step) AS BIGINT) AS max_tick, count(DISTINCT time_step) AS n_ticks FROM ens GROUP BY set_num'))
def timeline_profile(spark, sf):
    return wide(audit.timeline(ens(spark, sf)))


@query(with_ens('SELECT CAST(set_num AS BIGINT) AS set_num, count(DISTINCT CASE WHEN run_num BETWEEN 2 AND 6 THEN run_num END) AS matching_runs, count(DISTINCT run_num) AS total_runs FROM ens WHERE set_num BETWEEN 1 AND 5 GROUP BY set_num'))
def run_counts(spark, sf):
    return wide(audit.run_counts(ens(spark, sf), "1-5", "2-6"))


@query(with_ens("SELECT count(DISTINCT CASE WHEN set_num BETWEEN 1 AND 5 THEN set_num END) AS selected_sets, count(DISTINCT set_num) AS total_sets, count(DISTINCT CASE WHEN set_num BETWEEN 1 AND 5 AND run_num BETWEEN 2 AND 6 THEN set_num * 100 + run_num END) AS cells FROM ens"))
def selection_totals(spark, sf):
    return audit.selection_totals(ens(spark, sf), "1-5", "2-6")


def _supplier_cells(spark, sf):
    return table(spark, sf, "supplier").select((F.col("s_nationkey") + 1).alias("set_num"), (F.col("s_suppkey") % 20 + 1).alias("run_num"))


CELLS_SQL = "SELECT DISTINCT CAST(s_nationkey + 1 AS BIGINT) AS set_num, CAST(s_suppkey % 20 + 1 AS BIGINT) AS run_num FROM supplier"


@query(f"SELECT s.set_num, r.run_num FROM (SELECT unnest(generate_series(1, 25)) AS set_num) s CROSS JOIN (SELECT unnest(generate_series(1, 20)) AS run_num) r ANTI JOIN ({CELLS_SQL}) c ON s.set_num = c.set_num AND r.run_num = c.run_num")
def missing_cells(spark, sf):
    return wide(audit.missing_cells(_supplier_cells(spark, sf), "1-25", "1-20"))


@query(f"SELECT s.set_num, count(c.run_num) AS runs, count(c.run_num) = 20 AS complete FROM (SELECT unnest(generate_series(1, 25)) AS set_num) s LEFT JOIN ({CELLS_SQL}) c ON s.set_num = c.set_num GROUP BY s.set_num")
def complete_sets(spark, sf):
    return wide(audit.complete_sets(_supplier_cells(spark, sf), "1-25", "1-20"))


@query(f"SELECT set_num, min(run_num) AS first_run FROM ({CELLS_SQL}) GROUP BY set_num")
def first_run_sample(spark, sf):
    return wide(audit.first_runs(_supplier_cells(spark, sf)))


@query(with_ens("SELECT status, count(*) AS n FROM (SELECT DISTINCT set_num, run_num FROM ens) CROSS JOIN (VALUES ('CONVERTED'), ('SKIPPED')) v(status) GROUP BY status"))
def status_tally(spark, sf):
    out, rows = scratch_path(spark, "twice"), ens(spark, sf)
    first = write_run_files(rows, out, "data_Agent.parquet", ["time_step", "ID"])
    second = write_run_files(rows, out, "data_Agent.parquet", ["time_step", "ID"])
    return audit.status_tally(first.unionByName(second))


@query(with_ens("SELECT CAST(set_num AS BIGINT) AS set_num, 'Agent' AS agent, count(DISTINCT run_num) AS files FROM ens GROUP BY set_num"))
def agent_census(spark, sf):
    return wide(audit.agent_census(table_files(spark, run_tree(spark, sf))))


@query(with_ens("SELECT 'Agent' AS agent, variable, type, position, files, false AS drift FROM (SELECT count(DISTINCT set_num * 100 + run_num) AS files FROM ens) CROSS JOIN (VALUES ('ID', 'int64', 1), ('x', 'float', 2), ('y', 'float', 3), ('part', 'int64', 4), ('price', 'double', 5)) v(variable, type, position)"))
def schema_drift(spark, sf):
    return wide(schema_manifest(spark, run_tree(spark, sf)))


# ---- shaping


SIM_SQL = """SELECT CAST(l_linenumber AS SMALLINT) AS set_num, CAST(l_suppkey % 10 + 1 AS SMALLINT) AS run_num, l_orderkey AS agent_id,
  (year(l_shipdate) - 1990) * 12 + month(l_shipdate) AS iteration, l_quantity AS a, l_partkey AS b, l_extendedprice AS x, l_returnflag AS flag FROM lineitem"""


def _sim_rows(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_linenumber").cast("smallint").alias("set_num"), (F.col("l_suppkey") % 10 + 1).cast("smallint").alias("run_num"),
        F.col("l_orderkey").alias("agent_id"), ((F.year("l_shipdate") - 1990) * 12 + F.month("l_shipdate")).alias("iteration"),
        F.col("l_quantity").alias("a"), F.col("l_partkey").alias("b"), F.col("l_extendedprice").alias("x"), F.col("l_returnflag").alias("flag"),
    )


@query(f'SELECT set_num, run_num, iteration AS time_step, agent_id AS "ID", a, b, x, flag FROM ({SIM_SQL})')
def canonicalize(spark, sf):
    return shaping.canonicalize(_sim_rows(spark, sf))


@query(f"""SELECT set_num, run_num, TRY_CAST(agent_id * 7 AS SMALLINT) AS "ID", TRY_CAST(iteration AS SMALLINT) AS time_step, CAST(a AS FLOAT) AS a,
  TRY_CAST(b * 40 AS SMALLINT) AS b, CAST(x AS FLOAT) AS x, flag FROM ({SIM_SQL})""")
def downcast_policy(spark, sf):
    rows = _sim_rows(spark, sf).withColumn("agent_id", F.col("agent_id") * 7).withColumn("b", F.col("b") * 40)
    return shaping.downcast(shaping.canonicalize(rows), "checked")


@query(f"""SELECT set_num, run_num, count(*) AS rows, count(*) FILTER (WHERE TRY_CAST(agent_id * 7 AS SMALLINT) IS NULL) AS "ID",
  CAST(0 AS BIGINT) AS time_step, count(*) FILTER (WHERE TRY_CAST(b * 40 AS SMALLINT) IS NULL) AS b FROM ({SIM_SQL}) GROUP BY set_num, run_num""")
def downcast_rejects(spark, sf):
    rows = _sim_rows(spark, sf).withColumn("agent_id", F.col("agent_id") * 7).withColumn("b", F.col("b") * 40)
    return shaping.reject_counts(shaping.canonicalize(rows))


@query("""SELECT l_orderkey, l_linenumber, CAST(l_partkey AS BIGINT) AS whole, CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_suppkey AS DOUBLE) + 0.5 END AS fraction,
  concat('+', l_suppkey) AS plus, concat(l_suppkey, 'e5') AS exponent, l_returnflag AS flag FROM lineitem""")
def numeric_promotion(spark, sf):
    text = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit(" "), F.col("l_partkey").cast("string"), F.lit("  ")).alias("whole"),
        F.when(F.col("l_linenumber") == 7, F.lit(" ")).otherwise(F.concat(F.col("l_suppkey").cast("string"), F.lit(".5"))).alias("fraction"),
        F.concat(F.lit("+"), F.col("l_suppkey").cast("string")).alias("plus"),
        F.concat(F.col("l_suppkey").cast("string"), F.lit("e5")).alias("exponent"),
        F.col("l_returnflag").alias("flag"),
    )
    return shaping.infer_numeric_strings(text)


@query("""SELECT o_orderkey, CAST(regexp_extract(o_orderpriority, '(\\d+)', 1) AS INT) AS set_num FROM orders""")
def set_from_label(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", label_number("o_orderpriority").alias("set_num"))


@query("""SELECT c_custkey, CAST(regexp_extract(c_name, '(\\d+)$', 1) AS INT) AS trailing, 'Set_' || c_nationkey AS set_label, 'RUN_' || c_custkey AS run_label,
  'F' || c_nationkey AS agent, c_mktsegment = 'BUILDING' AS is_building FROM customer""")
def name_parts(spark, sf):
    nation, key = F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")
    db = F.concat(F.lit("Set_"), nation, F.lit("_RUN_"), key, F.lit("_iters.db"))
    return table(spark, sf, "customer").select(
        "c_custkey", trailing_number("c_name").alias("trailing"), flat_db_part(db, 1).alias("set_label"), flat_db_part(db, 2).alias("run_label"),
        table_of_file(F.concat(F.lit("data_F"), nation, F.lit(".parquet"))).alias("agent"),
        has_token(F.concat(F.lit("checkpoint_"), F.col("c_mktsegment")), "BUILDING").alias("is_building"),
    )


@query(ENS_ROWS + ' ORDER BY set_num, run_num, time_step, "ID"')
def coordinate_sort(spark, sf):
    return wide(shaping.coordinate_sort(ens(spark, sf)))


@query(with_ens("""SELECT CAST(set_num AS BIGINT) AS set_num, CAST(x AS DOUBLE) AS v, CAST("ID" AS BIGINT) AS "ID", NULL AS status FROM ens UNION ALL
  SELECT CAST(regexp_extract(o_orderpriority, '(\\d+)', 1) AS BIGINT), CAST(o_custkey % 100 AS DOUBLE), NULL, o_orderstatus FROM orders"""))
def union_runs(spark, sf):
    a = ens(spark, sf).select("set_num", F.col("x").alias("v"), "ID")
    b = table(spark, sf, "orders").select(
        label_number("o_orderpriority").alias("set_num"), (F.col("o_custkey") % 100).cast("smallint").alias("v"), F.col("o_orderstatus").alias("status")
    )
    return wide(shaping.union_runs(a, b))


# ---- layouts on disk, written from the tables and read back


RUN_SIZES = "SELECT CAST(set_num AS BIGINT) AS set_num, CAST(run_num AS BIGINT) AS run_num, count(*) AS n_rows FROM ens GROUP BY ALL"


@query(ENS_ROWS.replace('CAST("price" AS DOUBLE)', 'CAST(CAST("price" AS FLOAT) AS DOUBLE)'))
def tree_scan(spark, sf):
    return wide(read_tree(spark, run_tree(spark, sf), "Agent", mode="widen"))


@query(with_ens(f'SELECT {big("set_num", "run_num", "time_step", "ID", "part")}, {dbl("x", "y")}, CAST(CAST(price AS FLOAT) AS DOUBLE) AS price FROM ens WHERE set_num BETWEEN 2 AND 4 AND run_num BETWEEN 1 AND 5'))
def tree_scan_ranges(spark, sf):
    return wide(read_tree(spark, run_tree(spark, sf), "Agent", "2-4", "1-5", mode="widen"))


@query(with_ens(f'SELECT {big("set_num", "run_num", "time_step", "ID")}, CAST(part AS BIGINT) + 40000 AS part FROM ens'))
def tree_scan_default(spark, sf):
    """Whole numbers beyond 16 bits keep their values without a word about modes."""
    root = scratch_path(spark, "wide-tree")
    rows = ens(spark, sf).select("set_num", "run_num", "time_step", "ID", (F.col("part") + 40000).alias("part"))
    write_run_files(rows, root, "data_Agent.parquet", ["time_step", "ID", "part"])
    return wide(read_tree(spark, root, "Agent"))


@query("""SELECT o_orderkey % 3 + 1 AS set_num, o_custkey % 2 + 1 AS run_num, o_orderkey % 11 AS time_step, o_orderkey AS "ID", strftime(o_orderdate, '%Y-%m-%d') AS day,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed, CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR) AS cost, [o_orderstatus, o_orderpriority][2] AS tag FROM orders""")
def tree_scan_types(spark, sf):
    """Dates, local times, decimals and lists in run files pass as they are."""
    root, key = scratch_path(spark, "typed-tree"), F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        (key % 3 + 1).cast("int").alias("set_num"), (F.col("o_custkey") % 2 + 1).cast("int").alias("run_num"), (key % 11).alias("time_step"), key.alias("ID"),
        F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderdate").alias("placed"), F.col("o_totalprice").cast("decimal(15,2)").alias("cost"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
    )
    write_run_files(rows, root, "data_Order.parquet", ["time_step", "ID"])
    back = read_tree(spark, root, "Order")
    shown = [F.date_format("day", "yyyy-MM-dd").alias("day"), F.date_format("placed", "yyyy-MM-dd HH:mm:ss").alias("placed"), F.col("cost").cast("string").alias("cost"), F.get("tags", F.lit(1)).alias("tag")]
    return wide(back.select("set_num", "run_num", "time_step", "ID", *shown))


@query(with_ens(f'SELECT CAST(set_num AS BIGINT) + 40000 AS set_num, CAST(run_num AS BIGINT) + 70000 AS run_num, {big("time_step", "ID", "part")} FROM ens WHERE set_num <= 3'))
def large_set_numbers(spark, sf):
    root = scratch_path(spark, "many-sets")
    rows = ens(spark, sf).select((F.col("set_num") + 40000).alias("set_num"), (F.col("run_num") + 70000).alias("run_num"), "time_step", "ID", "part")
    write_run_files(rows, root, "data_Agent.parquet", ["time_step", "ID", "part"])
    return wide(read_tree(spark, root, "Agent", "40001-40003"))


@query(with_ens(f'SELECT {big("set_num", "run_num")}, pos // 3 + 1 AS time_step, CAST(time_step AS BIGINT) AS tick, {dbl("x", "y")} FROM ({STRIDE_SQL}) WHERE pos % 3 = 0'))
def metric_scan(spark, sf):
    return wide(read_metric(spark, run_tree(spark, sf), "Agent", ["x", "y"], stride=3))


@query(ENS_ROWS)
def checkpoint_table(spark, sf):
    out = scratch_path(spark, "checkpoints")
    write_checkpoint(ens(spark, sf), out, "Agent")
    return wide(resolve_agent(spark, out, "Agent"))


@query(with_ens(f'SELECT {big("set_num", "run_num", "time_step")}, {dbl("y")} FROM ens'))
def metric_checkpoint(spark, sf):
    paths = write_metric_checkpoints(ens(spark, sf), "x, y", scratch_path(spark, "metrics"))
    return wide(spark.read.parquet(paths["y"]))


@query(with_ens(f"SELECT {big('set_num', 'run_num', 'time_step')}, 'x' AS metric, CAST(x AS DOUBLE) AS v FROM ens UNION ALL SELECT {big('set_num', 'run_num', 'time_step')}, 'y', CAST(y AS DOUBLE) FROM ens"))
def metric_checkpoints_both(spark, sf):
    paths = write_metric_checkpoints(ens(spark, sf), "x, y", scratch_path(spark, "metrics"))
    x, y = (spark.read.parquet(paths[m]).select("set_num", "run_num", "time_step", F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in ("x", "y"))
    return wide(x.unionByName(y))


@query(ENS_ROWS)
def mirrored_tables(spark, sf):
    return wide(spark.read.parquet(mirror_tables(ens(spark, sf), scratch_path(spark, "mirror"), "Agent")))


@query(ENS_ROWS)
def compacted(spark, sf):
    return wide(spark.read.parquet(compact(ens(spark, sf), scratch_path(spark, "compact"), 50_000, "zstd")))


@query(ENS_ROWS)
def materialized(spark, sf):
    path = scratch_path(spark, "copy")
    materialize(ens(spark, sf), path)
    return wide(materialize(ens(spark, sf).where(F.lit(False)), path))


@query(with_ens("SELECT CAST(set_num AS BIGINT) AS set_num, CAST(run_num AS BIGINT) AS run_num FROM (SELECT DISTINCT set_num, run_num FROM ens) WHERE set_num > 3"))
def unseen_files(spark, sf):
    files = table_files(spark, run_tree(spark, sf))
    seen = scratch_path(spark, "seen")
    remember_files(files.where(F.col("set_num") <= 3), seen)
    return wide(new_files(files, seen).select("set_num", "run_num"))


@query(ENS_ROWS)
def feather_round_trip(spark, sf):
    folder = scratch_path(spark, "feather")
    write_feather(ens(spark, sf), folder)
    return wide(read_feather(spark, folder))


@query(ENS_ROWS.replace('CAST("time_step" AS BIGINT) AS "time_step"', 'CAST(time_step AS BIGINT) AS "_ITERATION_NO"'))
def tar_scan(spark, sf):
    return wide(read_tar_tree(spark, archives(spark, sf), "data_Agent.parquet", "1-7", "1-10"))


@query(ENS_ROWS.replace('CAST("time_step" AS BIGINT) AS "time_step"', 'CAST(time_step AS BIGINT) AS "_ITERATION_NO"').replace('CAST("y" AS DOUBLE)', 'CAST("y" AS BIGINT)'))
def sqlite_scan(spark, sf):
    return wide(shaping.infer_numeric_strings(ingest_sqlite_tree(spark, databases(spark, sf)).read("Agent")))


@query(with_ens("SELECT 'CONVERTED' AS status, count(*) AS n FROM (SELECT DISTINCT set_num, run_num FROM ens)"))
def sqlite_conversion(spark, sf):
    return jobs.convert_databases(spark, databases(spark, sf), scratch_path(spark, "converted"))


@query(ENS_ROWS.replace('CAST("price" AS DOUBLE)', 'CAST(CAST("price" AS FLOAT) AS DOUBLE)').replace('CAST("y" AS DOUBLE)', 'CAST("y" AS BIGINT)'))
def sqlite_converted_rows(spark, sf):
    out = scratch_path(spark, "converted")
    jobs.convert_databases(spark, databases(spark, sf), out)
    return wide(read_tree(spark, out, "Agent"))


@query(with_ens("""SELECT pass, set_num, run_num, name, status, CASE WHEN status = 'CONVERTED' THEN n_rows ELSE 0 END AS rows_written FROM (
  SELECT 1 AS pass, set_num, run_num, '' AS name, 'CONVERTED' AS status, n_rows FROM sizes WHERE set_num <= 3
  UNION ALL SELECT 2, set_num, run_num, '', CASE WHEN set_num <= 3 THEN 'SKIPPED' ELSE 'CONVERTED' END, n_rows FROM sizes
  UNION ALL SELECT p, set_num, run_num, name, status, 0 FROM (SELECT DISTINCT set_num FROM sizes) JOIN (VALUES (1), (2)) passes(p) ON p = 2 OR set_num <= 3
    CROSS JOIN (VALUES (11, '', 'EMPTY'), (12, '', 'ERROR'), (13, 'a', 'INCOMPLETE'), (13, 'b', 'ERROR')) v(run_num, name, status))""", sizes=RUN_SIZES))
def conversion_outcomes(spark, sf):
    """What became of each database: the first three sets are converted, then all of them."""
    root, out = databases(spark, sf, odd=True), scratch_path(spark, "converted")
    passes = []
    for n, sets in ((1, "1-3"), (2, None)):
        jobs.convert_databases(spark, root, out, sets)
        ledger = settle(spark.read.parquet(f"{out}/{jobs.LEDGER}"), "outcomes")
        name = F.regexp_extract("path", r"_run_13_([ab])\.db$", 1)
        passes.append(ledger.select(F.lit(n).alias("pass"), "set_num", "run_num", name.alias("name"), "status", "rows_written"))
    return wide(passes[0].unionByName(passes[1]))


@query(with_ens('SELECT CAST(time_step AS BIGINT) AS itno, 1.5 AS const_radius, CAST("ID" AS BIGINT) AS id, CAST(set_num AS BIGINT) AS set_num, CAST(run_num AS BIGINT) AS run_num, CAST(part AS BIGINT) AS part, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, price FROM ens').replace("1.5 AS", "CAST(1.5 AS DOUBLE) AS"))
def xml_snapshots(spark, sf):
    agent = "name string, id bigint, set_num int, run_num int, part bigint, x float, y float, price double"
    rows = read_xml_snapshots(spark, snapshots_xml(spark, sf) + "/*", "Agent", agent, "set_no int, const_radius double")
    return wide(rows.select("itno", F.col("env.const_radius").alias("const_radius"), "id", "set_num", "run_num", "part", "x", "y", "price"))


@query(with_ens('SELECT CAST(time_step AS BIGINT) AS iteration, CAST("ID" AS BIGINT) AS agent_id, CAST(part AS DOUBLE) AS a, price AS b, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM ens'))
def tick_snapshots(spark, sf):
    return wide(read_snapshots(spark, snapshot_files(spark, sf), "Agent"))


@query(with_ens('SELECT CAST(NULL AS BIGINT) AS set_num, CAST(NULL AS BIGINT) AS run_num, CAST(time_step AS BIGINT) AS time_step, CAST("ID" AS BIGINT) AS "ID", CAST(CAST(part AS FLOAT) AS DOUBLE) AS a, CAST(CAST(price AS FLOAT) AS DOUBLE) AS b, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM ens'))
def snapshot_coordinates(spark, sf):
    """Snapshots as a canonical table, from files with ids of two widths, some without a tick of their own."""
    return wide(read_snapshot_tree(spark, snapshot_files(spark, sf, mixed=True), "Agent", flat=True).rows)


# ---- split runs, files left out


PLACED_SQL = "SELECT *, row_number() OVER (PARTITION BY set_num, run_num ORDER BY time_step, \"ID\", part, price) - 1 AS pos FROM ens"


@query(with_ens(f"""SELECT 'tree' AS reader, {big("set_num", "run_num", "time_step")}, pos AS place, {dbl("x")} FROM ({PLACED_SQL})
  UNION ALL SELECT 'metric', {big("set_num", "run_num", "time_step")}, pos // 4 + 1, {dbl("x")} FROM ({PLACED_SQL}) WHERE pos % 4 = 0"""))
def split_run_scan(spark, sf):
    """Runs in pieces of a year: surrogate IDs and ordinals run on from piece to piece."""
    root = scratch_path(spark, "split-tree")
    rows = ens(spark, sf).withColumnsRenamed({"time_step": "_ITERATION_NO", "ID": "order_key"})
    write_run_files(rows, root, "data_Agent.parquet", ["_ITERATION_NO", "order_key", *TIE], ticks_per_file=12)
    by_tree = read_tree(spark, root, "Agent").select(F.lit("tree").alias("reader"), "set_num", "run_num", "time_step", F.col("ID").alias("place"), "x")
    metric = read_metric(spark, root, "Agent", "x", stride=4)
    by_metric = metric.select(F.lit("metric").alias("reader"), "set_num", "run_num", F.col("tick").alias("time_step"), F.col("time_step").alias("place"), "x")
    return wide(by_tree.union(by_metric))


def _uneven_tree(spark, sf) -> str:
    """A tree in which the runs of set 6 have no tick and those of set 7 no ``x``, with helper tables and other files beside."""

    def make(root: str) -> None:
        rows = ens(spark, sf).withColumnRenamed("time_step", "_ITERATION_NO")
        order = ["_ITERATION_NO", "ID", *TIE]
        write_run_files(rows.where("set_num < 6"), root, "data_Agent.parquet", order)
        write_run_files(rows.where("set_num = 6").withColumnRenamed("_ITERATION_NO", "month"), root, "data_Agent.parquet", ["month", *order[1:]])
        write_run_files(rows.where("set_num > 6").drop("x"), root, "data_Agent.parquet", order)
        months = rows.groupBy("set_num", "run_num", "_ITERATION_NO").agg(F.count(F.lit(1)).alias("n"))
        for name in ("data_Agent_iters_0.parquet", "months.parquet"):
            write_run_files(months, root, name, ["_ITERATION_NO"])

    return once(spark, sf, "uneven-tree", make)




@query(with_ens("""SELECT 'tree' AS reader, set_num, run_num, n_rows, 'no tick column' AS reason FROM sizes WHERE set_num = 6
  UNION ALL SELECT 'metric', set_num, run_num, n_rows, 'no column x' FROM sizes WHERE set_num > 6""", sizes=RUN_SIZES))
def skipped_files(spark, sf):
    """Which files a reading left out, with their rows and why, as a checkpoint job writes it beside its table."""
    root, out = _uneven_tree(spark, sf), scratch_path(spark, "ledgered")
    jobs.build_checkpoints(spark, root, out, "Agent")
    by_tree = spark.read.parquet(f"{out}/skipped_Agent.parquet")
    by_metric = read_metric_ledgered(spark, root, "Agent", "x")[1]
    parts = [df.select(F.lit(n).alias("reader"), "set_num", "run_num", "n_rows", "reason") for n, df in (("tree", by_tree), ("metric", by_metric))]
    return wide(parts[0].unionByName(parts[1]))


@query(with_ens("""SELECT set_num, run_num, name, reason FROM sizes CROSS JOIN (VALUES ('data_Agent.parquet', NULL),
  ('data_Agent_iters_0.parquet', 'helper table'), ('months.parquet', 'not named data_*')) v(name, reason)""", sizes=RUN_SIZES))
def table_exclusion(spark, sf):
    """Every file of the run folders: run tables, and those left out by their name."""
    root = _uneven_tree(spark, sf)
    tables = table_files(spark, root).withColumn("reason", F.lit(None).cast("string"))
    parts = [df.select("set_num", "run_num", F.substring_index("path", "/", -1).alias("name"), "reason") for df in (tables, excluded_tables(spark, root))]
    return wide(parts[0].unionByName(parts[1]))


# ---- views, user functions, incremental


VIEW_STYLES = {
    "band": ({"plot_style": "time_series"}, {"v1": "mean_val", "v2": "min_val", "v3": "max_val"}),
    "delay": ({"plot_style": "delay_plot", "delay_lag": 2}, {"v1": "current_val", "v2": "lagged_val"}),
    "xy": ({"plot_style": "scatter_plot", "secondary_variable": "y", "target_iteration": EVERY_TICK}, {"v1": "x_val", "v2": "y_val"}),
    "bins": ({"plot_style": "histogram", "target_iteration": EVERY_TICK}, {"v1": "bin", "v2": "bin_lo", "v3": "bin_hi", "v4": "n"}),
    "box": ({"plot_style": "box_plot", "target_iteration": EVERY_TICK}, {"v1": "q1", "v2": "median", "v3": "q3", "v4": "whisker_lo", "v5": "whisker_hi", "v6": "n", "v7": "n_outliers"}),
}
VIEW_SQL = {
    "band": BAND_SQL, "delay": DELAY_SQL,
    "xy": "SELECT CAST(set_num AS BIGINT) AS set_num, CAST(time_step AS BIGINT) AS iteration, x AS x_val, y AS y_val FROM ens",
    "bins": "WITH " + histogram_sql(SNAPSHOT_SQL, "iteration, set_num", "target_value", 30),
    "box": "WITH " + box_sql(SNAPSHOT_SQL, "iteration, set_num", "target_value") + """SELECT iteration, set_num, n, q1, median, q3,
    least(q1, min(CASE WHEN inside THEN CAST(v AS DOUBLE) END)) AS whisker_lo, greatest(q3, max(CASE WHEN inside THEN CAST(v AS DOUBLE) END)) AS whisker_hi,
    count(*) FILTER (WHERE NOT inside) AS n_outliers FROM f GROUP BY iteration, set_num, n, q1, median, q3""",
}


def _view_sql(name: str) -> str:
    shown = VIEW_STYLES[name][1]
    values = ", ".join(f"CAST({shown.get(f'v{k}', 'NULL')} AS DOUBLE) AS v{k}" for k in range(1, 8))
    return f"SELECT '{name}.png' AS view, set_num, iteration, {values} FROM ({VIEW_SQL[name]})"


@query(with_ens(" UNION ALL ".join(_view_sql(name) for name in VIEW_STYLES)))
def view_runner(spark, sf):
    """All five styles over one agent type, through one scan of it."""
    shared = {"agent_type": "Agent", "variable_name": "x"}
    plots = [{**shared, **style, "output_filename": f"{name}.png"} for name, (style, _) in VIEW_STYLES.items()]
    made = run_views(spark, {"comparison_sets": [f"set_{s}" for s in SETS], "time_variable": "time_step", "plots": plots}, ens(spark, sf))
    parts = []
    for name, (_, shown) in VIEW_STYLES.items():
        values = [(F.col(shown[f"v{i}"]) if f"v{i}" in shown else F.lit(None)).cast("double").alias(f"v{i}") for i in range(1, 8)]
        parts.append(made[f"{name}.png"].select(F.lit(f"{name}.png").alias("view"), "set_num", "iteration", *values))
    return wide(reduce(DataFrame.unionByName, parts))


@query(with_ens(f'SELECT {big("set_num", "run_num", "time_step")}, avg(x) AS x FROM ens WHERE time_step BETWEEN 61 AND 143 GROUP BY set_num, run_num, time_step'))
def analysis_spec(spark, sf):
    spec = {
        "agent": "Agent", "analysis": "multiple_run", "variables": {"var1": ["x"]}, "set": ["range", [1, 7]], "run": ["range", [1, 10]],
        "major": ["range", [61, 143, 1]], "summary": "mean",
    }
    return wide(run_analysis(ens(spark, sf), "timeseries", spec)["x"])


@query(with_ens(f'SELECT {big("set_num", "run_num")}, CAST(max(time_step) AS BIGINT) AS last_tick, count(*) AS rows, max(CAST(x AS DOUBLE)) AS top FROM ens GROUP BY set_num, run_num'))
def per_run_function(spark, sf):
    schema = "set_num smallint, run_num smallint, last_tick bigint, rows bigint, top double"

    def part(pdf):
        return pdf.groupby(["set_num", "run_num"], as_index=False).agg(last_tick=("time_step", "max"), rows=("x", "size"), top=("x", "max"))

    def whole(pdf):
        return pdf.groupby(["set_num", "run_num"], as_index=False).agg(last_tick=("last_tick", "max"), rows=("rows", "sum"), top=("top", "max"))

    return wide(per_run(ens(spark, sf).select("set_num", "run_num", "time_step", "ID", "x"), part, schema, whole, ticks_per_piece=12))


STREAM_SCHEMA = "_ITERATION_NO smallint, ID bigint, x float, y float, part bigint, price double"


@query(ENS_ROWS.replace('CAST("price" AS DOUBLE)', 'CAST(CAST("price" AS FLOAT) AS DOUBLE)'))
def incremental_ingest(spark, sf):
    tree, out, state = run_tree(spark, sf), scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    for runs in ("set_*/run_[1-4]", "set_*/run_*"):  # the second pass finds only what is new
        rows = stream_tree(spark, f"{tree}/{runs}/data_Agent.parquet", STREAM_SCHEMA, "widen")
        ingest_new(rows, out, state).awaitTermination()
    return wide(spark.read.parquet(out))


@query(with_ens(BAND_SQL.replace("FROM ens", ", count(x) AS n FROM ens")))
def incremental_band(spark, sf):
    tree, out, state = run_tree(spark, sf), scratch_path(spark, "band-out"), scratch_path(spark, "band-state")
    rows = stream_tree(spark, f"{tree}/set_*/run_*/data_Agent.parquet", STREAM_SCHEMA, "widen", max_files=40)
    keep_band(rows, "x", out, state).awaitTermination()
    return wide(read_band(spark, out))
