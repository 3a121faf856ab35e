import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.operators.clean import clean_trips
from farelane.operators.features import split_target, to_vector, trip_features, with_target
from farelane.schema import CELLS_20, PROCESSED
from farelane.sources.trips import raw_trips


def test_golden_row(trips):
    row = list(with_target(trips({})).first())
    want = np.zeros(66)
    want[0] = 0.0
    want[1 + 5] = 1  # Saturday
    want[8 + 6] = 1  # July
    want[20] = 0.4
    want[21], want[22] = math.sin(2 * math.pi * 13 / 24), math.cos(2 * math.pi * 13 / 24)
    want[23], want[24] = 0.03209961648, 0.05247288589
    want[25 + CELLS_20.index("dr72j")] = 1
    want[45 + CELLS_20.index("dr5ru")] = 1
    want[65] = 11.0
    assert np.allclose(row, want, atol=1e-7)


def test_schema(trips):
    made = with_target(trips({}))
    assert made.columns == PROCESSED.names
    assert {t for _, t in made.dtypes} == {"float"}


def test_one_hot_sums(spark, folder):
    made = trip_features(clean_trips(raw_trips(spark, folder)))
    blocks = {"dow": range(1, 8), "month": range(8, 20), "pickup": range(25, 45), "dropoff": range(45, 65)}
    sums = made.select(*(sum((F.col(f"_{i}") for i in ids), F.lit(0.0)).alias(b) for b, ids in blocks.items()))
    seen = {b: {r[0] for r in sums.select(b).distinct().collect()} for b in blocks}
    assert seen["dow"] == seen["month"] == {1.0}
    assert seen["pickup"] <= {0.0, 1.0} and seen["dropoff"] <= {0.0, 1.0}


def test_year_is_not_clipped(trips):
    years = [r._20 for r in trip_features(trips({"pickup_datetime": "2008-06-01 12:00:00"}, {"pickup_datetime": "2021-06-01 12:00:00"})).collect()]
    assert years == pytest.approx([-0.1, 1.2])


def test_other_cells(trips):
    made = trip_features(trips({}), cells=["dr5", "dr7"])
    assert len(made.columns) == 29
    row = made.first()
    assert (row._25, row._26, row._27, row._28) == (0.0, 1.0, 1.0, 0.0)


def test_missing_values_give_null_features_not_errors(trips):
    row = trip_features(trips({"pickup_latitude": None, "pickup_datetime": None})).first()
    assert row._23 is None and row._20 is None
    assert sum(row[25:45]) == 0 and sum(row[1:20]) == 0


def test_split_target(trips):
    x, y = split_target(trips({}).drop("key"))
    assert y.columns == ["fare_amount"] and "fare_amount" not in x.columns


def test_vector(trips):
    row = to_vector(with_target(trips({}))).first()
    assert len(row.features) == 65 and row.label == 11.0


def test_projection_is_compiled_and_needs_no_shuffle(spark, folder, tmp_path):
    path = str(tmp_path / "trips")
    raw_trips(spark, folder).write.parquet(path)
    plan = with_target(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert all(line.lstrip(" +-:").startswith("*(1)") for line in plan.splitlines() if "Project [" in line)
