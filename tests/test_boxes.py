"""Box plots against numpy, by arrays and by brackets, and how often the source is read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.operators import distribution, joining, quantiles


def plain(values, reach):
    v = np.array(values, dtype=float)
    q1, m, q3 = np.percentile(v, [25, 50, 75])
    pad = (q3 - q1) * reach
    inside = v[(v >= q1 - pad) & (v <= q3 + pad)]
    least, most = (min(q1, inside.min()), max(q3, inside.max())) if len(inside) else (q1, q3)
    return len(v), q1, m, q3, least, most, len(v) - len(inside)


DATA = {
    "spread": "tan(id * 1.37D)",
    "hot value": "CASE WHEN id % 3 = 0 THEN 5.0D ELSE sin(id) * 100 END",
    "ties": "CAST(id % 17 AS double) * CAST(id % 5 AS double) - 20",
    "one value": "7.25D",
    "fence on values": "CASE WHEN id % 10 < 5 THEN 0.0D WHEN id % 10 < 8 THEN 1.0D WHEN id % 10 = 8 THEN 2.5D ELSE -1.5D END",
    "narrow": "1.7e15D + id % 3000",
    "few": "CASE WHEN id < 6 THEN id * id * 1.0D END",
}


@pytest.mark.parametrize("reach", [1.5, 0.0])
@pytest.mark.parametrize("way", ["arrays", "brackets", "salted brackets"])
def test_boxes_equal_numpy(spark, monkeypatch, way, reach):
    if way != "arrays":
        monkeypatch.setattr(quantiles, "SMALL_GROUP", 0)
        monkeypatch.setattr(quantiles, "BRACKET", 500)
    if way == "salted brackets":
        monkeypatch.setattr(joining, "BROADCAST_ROWS", 0)
    each = F.array(*[F.struct(F.lit(k).alias("g"), F.expr(sql).alias("v")) for k, sql in DATA.items()])
    df = spark.range(6_001).select(F.inline(each)).union(spark.sql("SELECT 'spread', double('nan') UNION ALL SELECT NULL, 1.0D"))
    got = {r.g: (r.n, r.q1, r.median, r.q3, r.whisker_lo, r.whisker_hi, r.n_outliers) for r in distribution.box_stats(df, "v", ["g"], reach).collect()}
    raw = df.dropna().toPandas()
    assert set(got) == set(DATA)
    for g, r in got.items():
        want = plain(raw[raw.g == g].v.dropna(), reach)
        assert (r[0], r[6]) == (want[0], want[6]) and list(r[1:6]) == pytest.approx(list(want[1:6]), rel=1e-14)


@pytest.mark.parametrize("small", [100_000, 0])
def test_two_reads(spark, monkeypatch, tmp_path, small):
    """Rows handed out by the source: each pass counts them once."""
    monkeypatch.setattr(quantiles, "SMALL_GROUP", small)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(20_000).selectExpr("id % 2 AS g", "tan(id) AS v").mapInPandas(count, "g long, v double")
    assert distribution.box_stats(df, "v", ["g"]).count() == 2
    assert seen.value == 2 * 20_000


def test_boxes_of_nothing(spark, monkeypatch):
    empty = spark.sql("SELECT 1 AS g, double(NULL) AS v")
    assert distribution.box_stats(empty, "v", ["g"]).count() == 0
    alone = distribution.box_stats(spark.sql("SELECT 3.5D AS v"), "v", []).first()
    assert tuple(alone) == (1, 3.5, 3.5, 3.5, 3.5, 3.5, 0)
