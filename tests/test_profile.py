import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from farelane.operators import chunks, districts, downcast, histogram, profile, quantiles, residuals
from farelane.operators.clean import clean_trips
from farelane.sources.trips import raw_trips


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 20_000
    pdf = pd.DataFrame(
        {
            "hot": np.where(rng.random(n) < 0.35, 5.0, rng.normal(5, 3, n)),
            "few": rng.integers(0, 3, n).astype(float),
            "tail": rng.exponential(1, n),
            "same": np.full(n, 2.0),
        }
    )
    pdf.loc[::7, "tail"] = np.nan
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("gather", [40, 4096])
def test_quantiles_are_exact(skewed, monkeypatch, gather):
    """With a small gather limit the search has to narrow several times."""
    monkeypatch.setattr(quantiles, "GATHER", gather)
    pdf, df = skewed
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.9999, 1.0]
    for row in quantiles.exact_quantiles(df, list(pdf.columns), probs).collect():
        assert row.value == pytest.approx(pdf[row.column].dropna().quantile(row.prob), abs=1e-9)


def test_quantiles_recover_from_a_wrong_sketch(skewed, monkeypatch):
    pdf, df = skewed
    monkeypatch.setattr(quantiles, "MARGIN", -0.2)  # brackets that miss on purpose
    monkeypatch.setattr(quantiles, "GATHER", 500)
    for row in quantiles.exact_quantiles(df, ["tail", "hot"], [0.1, 0.5, 0.9]).collect():
        assert row.value == pytest.approx(pdf[row.column].dropna().quantile(row.prob), abs=1e-9)


def test_describe_and_boxes(skewed):
    pdf, df = skewed
    want = pdf.describe()
    for row in profile.describe(df, list(pdf.columns)).collect():
        found = [row["count"], row["mean"], row["std"], row["min"], row["q25"], row["q50"], row["q75"], row["max"]]
        assert found == pytest.approx(list(want[row.column]))
    for row in profile.box_stats(df, list(pdf.columns)).collect():
        x = pdf[row.column].dropna()
        q1, q3 = x.quantile(0.25), x.quantile(0.75)
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert row.outliers == int(((x < lo) | (x > hi)).sum())
        assert (row.whisker_low, row.whisker_high) == (x[x >= lo].min(), x[x <= hi].max())


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    found = {r.column: r for r in profile.describe(df, ["a", "b"]).collect()}
    assert found["a"]["count"] == 0 and found["a"].q50 is None
    assert found["b"].q50 == 1.0
    empty = profile.box_stats(df.filter("b > 5"), ["a", "b"]).collect()
    assert all(r.q50 is None and r.outliers == 0 for r in empty)


def test_histogram_counts_everything_once(skewed):
    pdf, df = skewed
    counts, edges = np.histogram(pdf["hot"], bins=30)
    found = histogram.histogram(df, "hot", 30).orderBy("bin").collect()
    assert [r.n for r in found] == list(counts)
    assert [r.bin_lo for r in found] == pytest.approx(list(edges[:-1]))


def test_histogram_of_a_constant_and_of_nothing(spark, skewed):
    _, df = skewed
    assert sum(r.n for r in histogram.histogram(df, "same", 4).collect()) == 20_000
    assert [r.n for r in histogram.histogram(df.filter("same > 3"), "same", 4).collect()] == [0] * 4


def test_p_value():
    def by_integration(r, n):
        t, df = abs(r) * math.sqrt((n - 2) / (1 - r * r)), n - 2
        x = np.linspace(0, t, 200_001)
        log_c = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi)
        y = np.exp(log_c - (df + 1) / 2 * np.log1p(x * x / df))
        return 1 - 2 * np.trapezoid(y, x)

    for r, n in [(0.5, 10), (0.1, 400), (-0.3, 30), (0.01, 1000), (0.9, 5)]:
        assert profile.pearson_p_value(r, n) == pytest.approx(by_integration(r, n), abs=1e-8)
    assert profile.pearson_p_value(0.95, 100_000) == 0.0
    assert profile.pearson_p_value(0.0, 50) == pytest.approx(1.0)
    assert profile.pearson_p_value(1.0, 50) == 0.0


def test_correlation_matrix_has_null_for_constants(skewed):
    pdf, df = skewed
    found = {(r.i, r.j): r.r for r in profile.corr_long(df.fillna(0.0), list(pdf.columns)).collect()}
    assert found["hot", "same"] is None and found["same", "same"] is None
    assert found["hot", "few"] == pytest.approx(pdf["hot"].corr(pdf["few"]))
    assert len(found) == 16


def test_downcast(spark):
    df = spark.createDataFrame(
        [(1, 200, 70_000, 2**40, 0.1, 1e9 + 0.123), (-128, -5, 1, 1, 2.5, 1.0)],
        "a long, b long, c long, d long, x double, y double",
    )
    plan = {r.column: r.suggested for r in downcast.downcast_plan(df).collect()}
    assert plan == {"a": "tinyint", "b": "smallint", "c": "int", "d": "bigint", "x": "float", "y": "double"}
    small = downcast.apply_downcast(df, downcast.downcast_plan(df))
    assert dict(small.dtypes)["a"] == "tinyint" and small.agg(F.min("a")).first()[0] == -128


def test_top_districts_break_ties_by_name(trips):
    df = trips({}, {"pickup_latitude": 40.6}, {"pickup_latitude": 40.65})
    top = districts.top_districts(df, 3).collect()
    assert top[0].cell == "dr5ru" and top[0].n == 3
    assert [r.cell for r in top[1:]] == sorted(r.cell for r in top[1:])
    covered = districts.coverage(df, 20).collect()
    assert covered[-1].covered_pct == pytest.approx(100.0)


def test_coverage_reads_the_trips_once(spark, folder, tmp_path):
    path = str(tmp_path / "trips")
    raw_trips(spark, folder).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = districts.coverage(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in plan


def test_worst_k_limits_before_the_shuffle(spark, folder):
    scored = clean_trips(raw_trips(spark, folder)).withColumn("prediction", F.lit(20.0))
    worst = residuals.worst_k(scored, 3)
    plan = worst._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert worst.groupBy("band").count().agg(F.max("count")).first()[0] == 3


@pytest.mark.parametrize("parts", [1, 7])
def test_positions_with_a_hot_key_and_hot_copies(spark, monkeypatch, parts):
    monkeypatch.setattr(chunks, "BLOCK", 100)
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, 0L, id % 50) AS a", "IF(id % 3 = 0, 0L, id) AS b").repartition(parts)
    placed = chunks.with_chunk_id(df, ["a"], 250)
    rows = placed.orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(3000))
    assert [r.a for r in rows] == sorted(r.a for r in rows)
    assert all(r.chunk_id == r.pos // 250 for r in rows)
    assert placed.select("a", "b").exceptAll(df).isEmpty() and df.exceptAll(placed.select("a", "b")).isEmpty()


def test_hot_key_spreads_over_partitions(spark):
    df = spark.range(20_000).selectExpr("0L AS a", "id AS b")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = chunks.with_chunk_id(df, ["a"], 1000, distinct_rows=True)
        files = len([f for f in placed.inputFiles() if "part-" in f])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert files == 4


def test_slice(spark):
    placed = chunks.with_chunk_id(spark.range(100).toDF("v"), ["v"], 10)
    assert [r.v for r in chunks.chunk(placed, 25, 10).orderBy("v").collect()] == list(range(25, 35))
    assert chunks.chunk(placed, 95).count() == 5
    assert chunks.chunk(placed, 200, 10).count() == 0
