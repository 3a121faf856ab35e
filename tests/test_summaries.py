"""Monthly sketches and Gram matrices against whole-table figures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.operators import summaries
from farelane.operators.clean import clean_trips
from farelane.operators.profile import corr_long
from farelane.sources.trips import raw_trips
from farelane.staging import stage


@pytest.fixture(scope="module")
def clean(spark, folder):
    return stage(clean_trips(raw_trips(spark, folder)), "summaries")


def test_a_month_replaces_itself_and_reads_no_other(spark, clean, tmp_path):
    path = str(tmp_path)
    months = [r[0] for r in clean.select(summaries.month(clean)).distinct().collect()]
    first = summaries.month(clean) == months[0]
    summaries.put_months(summaries.monthly_sketches(clean.filter(first).limit(1)), path)  # replaced below
    for part in (first, ~first):
        summaries.put_months(summaries.monthly_sketches(clean.filter(part)), path)
    table = spark.read.parquet(path)
    assert table.count() == len(months)
    found = summaries.merged_counts(table).first()
    assert found["rows"] == clean.count()
    exact = clean.drop("key").distinct().count()
    assert abs(found["trips"] - exact) <= 0.02 * exact
    quantile = summaries.merged_quantiles(table, [0.5]).first()["value"]
    assert 0.48 <= clean.filter(F.col("fare_amount") < quantile).count() / clean.count() <= 0.52


def test_grams_add_up(spark, clean, tmp_path):
    columns, path = ["fare_amount", "passenger_count", "pickup_longitude", "zero"], str(tmp_path)
    rows = clean.withColumn("zero", F.lit(0.0))
    holes = rows.limit(3).withColumn("fare_amount", F.lit(None).cast("double"))
    early = F.col("pickup_datetime") < F.lit("2013-01-01").cast("timestamp_ntz")
    for part in (early, ~early):
        summaries.put_months(summaries.monthly_grams(rows.unionByName(holes).filter(part), columns, summaries.month(rows)), path)
    gram = summaries.total_gram(spark.read.parquet(path))
    x = np.array(rows.select(*(F.col(c).cast("double") for c in columns)).collect())
    whole = np.column_stack([np.ones(len(x)), x])
    assert np.allclose(gram, whole.T @ whole, rtol=1e-12)
    got = {(r.i, r.j): r.r for r in summaries.correlations(spark, gram, columns).collect()}
    want = {(r.i, r.j): r.r for r in corr_long(rows, columns).collect()}
    assert got.keys() == want.keys() and all((got[k] is None) == (v is None) and (v is None or abs(got[k] - v) < 1e-6) for k, v in want.items())
    target = summaries.total_gram(summaries.monthly_grams(rows, ["passenger_count", "pickup_longitude", "fare_amount"], summaries.month(rows)))
    intercept, weights = summaries.least_squares(target)
    plain = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x[:, 1], x[:, 2]]), x[:, 0], rcond=None)[0]
    assert np.allclose([intercept, *weights], plain, rtol=1e-4, atol=1e-4)


def test_no_months(spark, clean):
    none = clean.limit(0)
    assert summaries.monthly_sketches(none).count() == 0
    with pytest.raises(ValueError):
        summaries.total_gram(summaries.monthly_grams(none, ["fare_amount"], summaries.month(none)))
