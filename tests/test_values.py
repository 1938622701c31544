"""Quantiles, numbering, casts, names and sampling."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tickweave.functions.names import first_number, has_token, label_number, number_of, parse_range, trailing_number
from tickweave.functions.ticks import Ticks, axis, iterations, selected
from tickweave.operators import joining, levels, numbering, params, quantiles, selecting, shaping

INF, NAN = float("inf"), float("nan")


@pytest.fixture(autouse=True)
def usual_limits(monkeypatch):
    monkeypatch.setattr(quantiles, "SMALL_GROUP", quantiles.SMALL_GROUP)


@pytest.fixture(params=["small groups", "large groups"])
def both_ways(request, monkeypatch):
    monkeypatch.setattr(quantiles, "SMALL_GROUP", 0 if request.param == "large groups" else 100_000)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(width=32, allow_nan=False, allow_infinity=False), min_size=1, max_size=60), st.floats(0, 1))
def test_quantile_equals_numpy(spark, values, p):
    for kind, small in (("float", 0), ("double", 0), ("double", 100_000)):
        quantiles.SMALL_GROUP = small
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        got = quantiles.exact_quantiles(df, "v", {"q": p, "top": 1.0}).first()
        assert got.q == pytest.approx(float(np.percentile(np.array(values, dtype=np.float64), p * 100)), rel=1e-9, abs=1e-30)
        assert (got.n, got.top) == (len(values), max(values))


def test_quantile_of_one_hot_value(spark, both_ways):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).cast("double").alias("v"), (F.col("id") % 2).alias("g"))
    got = {r.g: r for r in quantiles.exact_quantiles(hot, "v", {"a": 0.1, "m": 0.5, "z": 0.9}, ["g"]).collect()}
    raw = hot.toPandas()
    for g, r in got.items():
        want = np.percentile(raw[raw.g == g].v, [10, 50, 90])
        assert [r.a, r.m, r.z] == pytest.approx(list(want))


def test_quantile_salted_path_equals_broadcast_path(spark, monkeypatch):
    df = spark.range(5_000).select((F.col("id") % 7).alias("g"), F.sin(F.col("id")).alias("v"))
    probs = {"q1": 0.25, "q3": 0.75}
    monkeypatch.setattr(quantiles, "SMALL_GROUP", 0)
    want = {r.g: tuple(r) for r in quantiles.exact_quantiles(df, "v", probs, ["g"]).collect()}
    monkeypatch.setattr(joining, "BROADCAST_ROWS", 0)
    assert {r.g: tuple(r) for r in quantiles.exact_quantiles(df, "v", probs, ["g"]).collect()} == want


@pytest.mark.parametrize("values", ["1.7e15D + id", "2147483647 - id", "CASE WHEN id < 60000 THEN 5.0D ELSE 5.0D + id * 1e-12D END"])
def test_quantile_brackets_stay_small(spark, monkeypatch, values):
    """Many distinct values in one bucket: doubles within one single-precision value, large integers, and a hot value among near ones."""
    monkeypatch.setattr(quantiles, "SMALL_GROUP", 0)
    monkeypatch.setattr(quantiles, "BRACKET", 1_000)
    seen = []
    settle = quantiles.settle
    monkeypatch.setattr(quantiles, "settle", lambda df, name: seen.append(settle(df, name)) or seen[-1])
    df = spark.range(100_000).selectExpr("CAST(id % 2 AS int) AS g", f"{values} AS v")
    got = quantiles.exact_quantiles(df, "v", {"a": 0.01, "m": 0.5, "z": 0.999}, ["g"]).collect()
    raw = df.toPandas()
    for r in got:
        assert [r.a, r.m, r.z] == pytest.approx(list(np.percentile(raw[raw.g == r.g].v, [1, 50, 99.9])), rel=1e-15)
    last = seen[-1].where("_lo < _hi").agg(F.max("_n")).first()[0]
    assert len(got) == 2 and (last or 0) <= 1_000 and len(seen) > 1


def test_infinities_and_nan(spark, both_ways):
    df = spark.createDataFrame([(v,) for v in (1.0, -INF, INF, NAN, None, 2.0)], "v double")
    got = quantiles.exact_quantiles(df, "v", {"lo": 0.0, "hi": 1.0}).first()
    assert (got.n, got.lo, got.hi) == (4, -INF, INF)
    assert quantiles.exact_quantiles(df, "v", {"hi": 1.0}, drop_nan=False).first().hi != INF


def test_bucket_is_monotone(spark):
    v = [-INF, -1e300, -5.0, -1e-320, 0.0, 5e-324, 1e-10, 1.0, 1.0000001, 3.5, 1e38, 1.7e308, INF, NAN]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, v double")
    b = [r[0] for r in rows.orderBy("i").select(quantiles.magnitude_bucket(F.col("v"))).collect()]
    assert b == sorted(b)


def test_positions_match_row_number(spark):
    rows = [(1, t, a) for t in range(5) for a in range(100)] + [(2, 1, 5)] * 40 + [(3, -7, 1), (3, -6, -20), (3, -6, 3), (3, -6, None), (3, None, 4)]
    df = spark.createDataFrame(rows, "g int, t int, a bigint")
    got = numbering.with_position(df, ["g"], ["t", "a"]).collect()
    for g in (1, 2, 3):
        low = -(10**9)  # nulls sort first
        mine = sorted((r.position, low if r.t is None else r.t, low if r.a is None else r.a) for r in got if r.g == g)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        assert [m[1:] for m in mine] == sorted((low if t is None else t, low if a is None else a) for gg, t, a in rows if gg == g)


def test_positions_spread_one_run(spark):
    """One run at one tick, with text names or nothing but copies, is dealt over several tasks of like size."""
    named = spark.range(20_000).select(F.lit(1).alias("g"), F.lit(3).alias("t"), F.sha2(F.col("id").cast("string"), 256).alias("a"), F.create_map(F.lit("k"), "id").alias("m"))
    copies = spark.range(20_000).select(F.lit(1).alias("g"), F.lit(3).alias("t"), F.lit("x").alias("a"))
    for df in (named, copies):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else such small data are one range
        try:
            sizes = [r["count"] for r in numbering.ranged(df, ["g", "t", "a"]).groupBy("_part").count().collect()]
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert len(sizes) > 1 and max(sizes) < 10_000
        got = numbering.with_position(df, ["g"], ["t", "a"])
        assert got.columns == [*df.columns, "position"]
        rows = sorted((r.position, r.a) for r in got.collect())
        assert [p for p, _ in rows] == list(range(1, 20_001)) and [a for _, a in rows] == sorted(a for _, a in rows)
    assert numbering.with_position(named.limit(0), ["g"], ["t", "a"]).count() == 0


def test_levels_roll_up(spark):
    rows = [(1, 1, 1, 1, 2), (1, 1, 1, 1, 4), (1, 1, 1, 2, None), (1, 2, 1, 1, 9), (None, 2, 1, 1, 5), (2, 1, 7, 1, None)]
    df = spark.createDataFrame(rows, "set_num int, run_num int, time_step int, ID int, v int")
    got = levels.analyze_all(df, "v")
    for level, keys in levels.LEVELS.items():
        mine = {tuple(r[k] for k in keys): (r.mean_val, r.n) for r in got.where(F.col("level") == level).collect()}
        assert mine == {tuple(r[k] for k in keys): (r.m, r.n) for r in df.groupBy(*keys).agg(F.avg("v").alias("m"), F.count("v").alias("n")).collect()}
    assert "Expand" not in got._jdf.queryExecution().toString()


def test_stride_and_ordinal(spark):
    df = spark.range(1, 1001).select(F.lit(1).alias("set_num"), F.lit(1).alias("run_num"), F.col("id").cast("int").alias("time_step"))
    rows = selecting.strided(df, 10).orderBy("ordinal").collect()
    assert [(r.time_step, r.ordinal) for r in rows[:3]] == [(1, 1), (11, 2), (21, 3)] and len(rows) == 100
    with pytest.raises(ValueError):
        selecting.strided(df, 0)


def test_overflow_policies(spark):
    df = spark.createDataFrame([(1, 1, 5, 1.5, 40000, 1e285), (1, 1, 6, 2.0, 7, NAN)], "set_num int, run_num int, time_step int, ID double, k int, v double")
    rows = shaping.downcast(df, "checked").orderBy("time_step").collect()
    assert [(r.ID, r.k) for r in rows] == [(None, None), (2, 7)] and rows[0].v == INF
    assert dict(shaping.downcast(df, "checked").dtypes) == {"set_num": "smallint", "run_num": "smallint", "time_step": "smallint", "ID": "bigint", "k": "smallint", "v": "float"}
    lost = shaping.reject_counts(df).first()
    assert (lost.ID, lost.k, lost.rows) == (1, 1, 2)
    assert [r.k for r in shaping.downcast(df).orderBy("time_step").collect()] == [40000, 7]
    with pytest.raises(Exception):
        shaping.downcast(df, "strict").collect()
    assert shaping.downcast(df.where("k = 7"), "strict").first().k == 7
    with pytest.raises(ValueError):
        shaping.downcast(df, "other")


def test_roles():
    r = shaping.resolve_roles(["iteration", "agent_id", "a", "b", "id", "x", "y"])
    assert (r.tick, r.agent, r.metrics) == ("iteration", "id", ("agent_id", "a", "b", "x", "y"))
    assert shaping.resolve_roles(["_ITERATION_NO", "v"]).tick == "_ITERATION_NO"
    assert shaping.resolve_roles(["v"]).tick is None


def test_text_promotion(spark):
    rows = [(" 1", "2.5", "1e5", "+3", "", "x"), ("", "-3", "2", "4", "  ", "1"), (None, "7", "3", "5", None, "2")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string")
    out = shaping.infer_numeric_strings(df)
    assert dict(out.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d": "string", "e": "string", "f": "string"}
    assert [r.a for r in out.collect()] == [1, None, None]


def test_union_widens_and_fills(spark):
    a = spark.createDataFrame([(1, 5)], "k int, v smallint")
    b = spark.createDataFrame([(2, 1.5, "s")], "k bigint, v float, w string")
    out = shaping.union_runs(a, b)
    assert dict(out.dtypes) == {"k": "bigint", "v": "float", "w": "string"}
    assert sorted(map(tuple, out.collect())) == [(1, 5.0, None), (2, 1.5, "s")]
    with pytest.raises(ValueError):
        shaping.union_runs(a, spark.createDataFrame([("x",)], "v string"))


def test_name_numbers(spark):
    df = spark.createDataFrame([("set_12",), ("12",), ("set_1_v2",), ("none",), ("run007",)], "n string")
    rows = [tuple(r) for r in df.select(first_number("n"), label_number("n"), trailing_number("n")).collect()]
    assert rows == [(12, 12, 12), (12, 12, 12), (1, None, 2), (None, None, None), (7, 7, 7)]
    assert number_of("set_3") == 3
    for bad in ("set", "set_1_2"):
        with pytest.raises(ValueError):
            number_of(bad)


def test_tokens(spark):
    df = spark.createDataFrame([("checkpoint_Firm",), ("checkpoint_SmallFirm",), ("Firm",), ("a-Firm-b",), ("Firms",)], "n string")
    assert [r[0] for r in df.select(has_token("n", "Firm")).collect()] == [True, False, True, True, False]


@pytest.mark.parametrize("text, want", [("5", (5, 5)), ("1-4", (1, 4)), (" 2-2 ", (2, 2)), (None, None), ("", None), ((1, 3), (1, 3)), (7, (7, 7))])
def test_ranges(text, want):
    assert parse_range(text) == want


@pytest.mark.parametrize("bad", ["4-1", "a-b", "1-2-3", "-5", (3, 1)])
def test_bad_ranges(bad):
    with pytest.raises(ValueError):
        parse_range(bad)


def test_tick_selections(spark):
    assert iterations() == [0] and iterations(4) == [4] and iterations({"start": 1, "stop": 10, "step": 4}) == Ticks(1, 10, 4)
    assert len(Ticks(1, 10, 4)) == 3 and axis(["range", [1, 4]]) == Ticks(1, 4, 1) and axis([1, 4]) == [1, 4]
    ticks = spark.range(0, 20).withColumnRenamed("id", "t")
    assert [r.t for r in ticks.where(selected("t", {"start": 1, "stop": 10, "step": 4})).collect()] == [1, 5, 9]
    with pytest.raises(ValueError):
        Ticks(5, 1)


def test_period_and_phase(spark):
    df = spark.range(10).withColumnRenamed("id", "time_step")
    assert [r.time_step for r in selecting.every(df, 4, 1).collect()] == [1, 5, 9]
    for period, phase in ((0, 0), (3, 3), (3, -1)):
        with pytest.raises(ValueError):
            selecting.every(df, period, phase)


def test_window_drops_negative_and_nan(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 2.0, 3.0, NAN, None, INF)], "v double")
    assert [r.v for r in selecting.clip_window(df, "v", 2.0).collect()] == [0.0, 2.0]


@pytest.mark.parametrize("n", [0, 1, 777, 4_999, 5_000, 6_000])
def test_capped_sample_is_exact_and_stable(spark, n):
    df = spark.range(5_000).withColumnRenamed("id", "k")
    a = sorted(r.k for r in selecting.cap_points(df, n).collect())
    b = sorted(r.k for r in selecting.cap_points(df.repartition(3), n).collect())
    assert a == b and len(a) == min(n, 5_000) == len(set(a))


def test_quantile_subset_keeps_bounds(spark):
    df = spark.range(1, 101).select(F.lit(1).alias("set_num"), F.lit(1).alias("time_step"), F.col("id").cast("double").alias("v"))
    assert selecting.quantile_subset(df, "v", 0.9, 1.0).count() == 10
    odd = df.unionAll(spark.createDataFrame([(1, 1, 9999.0)], "set_num int, time_step int, v double"))
    assert selecting.strip_outliers(odd, "v").agg(F.max("v")).first()[0] == 100.0


def test_parameters(spark):
    p = spark.createDataFrame([(1, 0.5, 9), (4, 1.5, 9)], "set_num int, alpha double, run_num int")
    assert params.parameter_names(p) == ["alpha"]
    spine = params.set_spine(p).orderBy("set_num").collect()
    assert [(r.set_num, r.alpha) for r in spine] == [(1, 0.5), (2, None), (3, None), (4, 1.5)]
    with pytest.raises(ValueError):
        params.set_spine(p.unionAll(p))
    assert params.parameter_domain(params.set_spine(p)).first().asDict() == {"param": "alpha", "x_min": 0.5, "x_max": 1.5}


def test_salted_join_is_the_join(spark):
    big = spark.range(1_000).select((F.col("id") % 3).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, w string")
    for how in ("inner", "left"):
        want = sorted(map(str, big.join(small, "k", how).collect()))
        assert sorted(map(str, joining.salted_join(big, small, ["k"], how).collect())) == want


def test_counting_is_the_same_beyond_the_broadcast_limit(spark, monkeypatch):
    from tickweave.operators import distribution

    df = spark.range(6_000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.exp(F.sin("id") * 4)).alias("v"))
    monkeypatch.setattr(quantiles, "SMALL_GROUP", 0)
    near = (distribution.histogram(df, "v", ["g"], 20), distribution.box_stats(df, "v", ["g"]))
    near = [sorted(map(tuple, d.collect())) for d in near]
    monkeypatch.setattr(joining, "BROADCAST_ROWS", 0)
    far = (distribution.histogram(df, "v", ["g"], 20), distribution.box_stats(df, "v", ["g"]))
    assert [sorted(map(tuple, d.collect())) for d in far] == near


def test_bins_are_those_of_numpy(spark):
    from tickweave.operators.distribution import histogram

    rng = np.random.default_rng(3)
    cases = {"tenths": np.arange(11) / 10, "cents": rng.integers(0, 5000, 3000) / 100, "whole": rng.integers(-40, 60, 3000).astype(float), "real": rng.normal(size=3000)}
    df = spark.createDataFrame([(k, float(x)) for k, v in cases.items() for x in v], "k string, v double")
    for bins in (10, 30, 50):
        got = {k: [0] * bins for k in cases}
        for r in histogram(df, "v", ["k"], bins).collect():
            got[r.k][r.bin] = r.n
        assert got == {k: np.histogram(v, bins)[0].tolist() for k, v in cases.items()}


def test_number_text_of_any_width(spark):
    df = spark.createDataFrame([("99999999999999999999", "\t7\r\n", "5"), ("1", " 8 ", "x")], "long string, padded string, word string")
    out = shaping.infer_numeric_strings(df)
    assert out.dtypes == [("long", "double"), ("padded", "bigint"), ("word", "string")]
    assert sorted((r.long, r.padded) for r in out.collect()) == [(1.0, 8), (1e20, 7)]


def test_joins_of_map_columns(spark):
    df = spark.range(20).selectExpr("id % 2 AS k", "id", "map('a', id) AS m")
    small = spark.createDataFrame([(0, "even"), (1, "odd")], "k bigint, word string")
    assert joining.salted_join(df, small, ["k"]).count() == 20
    assert sorted(r.p for r in numbering.with_position(df, ["k"], ["id"], name="p").collect()) == sorted(list(range(1, 11)) * 2)


def test_only_keys_and_addresses_are_sorted(spark, tmp_path, monkeypatch):
    """What is dealt and written is the same whatever else a table holds, and copies of a row are told apart by their address."""
    wide = spark.range(4_000).selectExpr("id % 3 AS g", "id % 50 AS t", "sha2(string(id), 512) AS a", "repeat(string(id), 40) AS b", "id % 2 AS c")
    wide.union(wide.where("t = 7")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    made = []
    settle = numbering.settle
    monkeypatch.setattr(numbering, "settle", lambda df, name: made.append((name, settle(df, name))) or made[-1][1])
    for df in (table, table.select("g", "t", "c").where("c = 1")):
        got = numbering.with_position(df, ["g"], ["t"]).collect()
        assert len(got) == df.count() and got[0].__fields__ == [*df.columns, "position"]
        for g in range(3):
            mine = sorted((r.position, r.t) for r in got if r.g == g)
            assert [p for p, _ in mine] == list(range(1, len(mine) + 1)) and [t for _, t in mine] == sorted(t for _, t in mine)
    assert [(name, df.columns) for name, df in made] == [("ranges", ["g", "t", "_in_file", "_in_row", "_part"])] * 2
    plan = numbering.with_position(table, ["g"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("repeat") == 0 and "Window" in plan
    exploded = table.where("t = 7").selectExpr("g", "t", "explode(array(1, 2)) AS e")  # one row of a file twice: an address of its own is needed
    assert not numbering.addressable(exploded) and not numbering.addressable(table.union(table)) and numbering.addressable(table.filter("t > 3").select("g"))
    places = sorted((r.g, r.position) for r in numbering.with_position(exploded, ["g"], ["t"]).collect())
    assert places == [(g, p) for g, n in sorted({r.g: r.n for r in exploded.groupBy("g").count().withColumnRenamed("count", "n").collect()}.items()) for p in range(1, n + 1)]
