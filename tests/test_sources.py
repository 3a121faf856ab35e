import pytest
from pyspark.sql import functions as F

from farelane.operators.clean import clean_trips
from farelane.operators.features import with_target
from farelane.plans.preprocess import preprocess
from farelane.schema import PROCESSED, RAW
from farelane.sources import catalog, feed, files
from farelane.sources.trips import raw_trips
from farelane.staging import remove_folder, shared_dir, stage, staged


def rows(df):
    return sorted(map(repr, df.collect()))


def test_csv_round_trip(spark, folder, tmp_path):
    raw = raw_trips(spark, folder)
    files.write_dataset(raw, str(tmp_path / "a"), fmt="csv")
    assert rows(files.read_raw(spark, str(tmp_path / "a"))) == rows(raw)


HEADER = ",".join(RAW.names)
GOOD = "k1,11.5,2013-07-06 17:18:00 UTC,-73.950655,40.783282,-73.984365,40.769802,1"


def test_text_files_with_and_without_header(spark, tmp_path):
    (tmp_path / "h.csv").write_text(f"{HEADER}\n{GOOD}\n")
    (tmp_path / "n.csv").write_text(f"{GOOD}\n")
    with_header = files.read_raw(spark, str(tmp_path / "h.csv"))
    without = files.read_raw(spark, str(tmp_path / "n.csv"), header=False)
    assert rows(with_header) == rows(without)
    assert files.check_schema(with_header, RAW) is with_header


@pytest.mark.parametrize("bad", ["k,11.5,soon,-73.9,40.7,-73.9,40.7,1", "k,11.5,2013-07-06 17:18:00 UTC,-73.9,40.7,-73.9,40.7,300", "k,11.5,2013-07-06 17:18:00 UTC,-73.9,40.7,-73.9,40.7,"])
def test_unreadable_fields_become_null_and_the_row_goes(spark, tmp_path, bad):
    (tmp_path / "x.csv").write_text(f"{HEADER}\n{GOOD}\n{bad}\n")
    read = files.read_raw(spark, str(tmp_path / "x.csv"))
    assert read.count() == 2
    assert clean_trips(read).count() == 1


def test_schema_check_refuses(spark, trips):
    with pytest.raises(TypeError):
        files.check_schema(trips({}).withColumn("fare_amount", F.lit("x")), RAW)
    with pytest.raises(TypeError):
        files.check_schema(trips({}).withColumn("more", F.lit(1)), RAW)
    with pytest.raises(TypeError):
        files.check_schema(trips({}).drop("key"), RAW)


def test_overwrite_then_append(spark, trips, tmp_path):
    path = str(tmp_path / "t")
    for fmt in ("parquet", "csv"):
        files.write_dataset(trips({}, {"key": "b"}), path + fmt, "overwrite", fmt)
        files.write_dataset(trips({}), path + fmt, "append", fmt)
        assert files.read_raw(spark, path + fmt, fmt).count() == 3
        files.write_dataset(trips({}), path + fmt, "overwrite", fmt)
        assert files.read_raw(spark, path + fmt, fmt).count() == 1


def test_catalog_table(spark, trips, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS fl LOCATION '" + str(tmp_path / "db") + "'")
    files.write_dataset(trips({}).withColumnRenamed("key", "0"), "fl.t", table=True)
    assert spark.table("fl.t").columns[0] == "_0"
    spark.sql("DROP DATABASE fl CASCADE")


def test_preprocess(spark, folder, tmp_path):
    raw = raw_trips(spark, folder)
    seen = preprocess(raw, str(tmp_path / "p"))
    assert seen.rows == raw.count()
    read = files.read_processed(spark, str(tmp_path / "p"))
    assert read.schema == PROCESSED and read.count() == seen.cleaned_rows
    assert rows(read) == rows(with_target(clean_trips(raw)))


def test_preprocess_by_month_prunes(spark, folder, tmp_path):
    path = str(tmp_path / "p")
    seen = preprocess(raw_trips(spark, folder), path, by_month=True)
    table = spark.read.parquet(path)
    assert table.count() == seen.cleaned_rows
    plan = table.filter("year = 2012 AND month = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert max(r["count"] for r in table.select(F.input_file_name().alias("f"), "year", "month").distinct().groupBy("year", "month").count().collect()) <= 2


def test_preprocess_of_nothing(spark, trips, tmp_path):
    seen = preprocess(trips({"fare_amount": -1.0}), str(tmp_path / "p"))
    assert (seen.rows, seen.cleaned_rows) == (1, 0)
    assert files.read_processed(spark, str(tmp_path / "p")).count() == 0


def test_catalog_rejects_unknown_names(spark):
    with pytest.raises(ValueError):
        catalog.make_catalog(spark, [("train", "2k", "raw", "csv", "/x")])
    with pytest.raises(ValueError):
        catalog.make_catalog(spark, [("train", "1k", "raw", "csv", "/x")] * 2)
    made = catalog.make_catalog(spark, [("train", "1k", "raw", "csv", "/x")])
    assert catalog.resolve(made, "train", "1k", "raw") == ("csv", "/x")
    with pytest.raises(LookupError):
        catalog.resolve(made, "val", "1k", "raw")
    assert catalog.dataset_name("val", "10k", "processed") == "val_processed_10k"


def test_feed(spark, trips, tmp_path):
    root = str(tmp_path)
    for split, n in (("train", 3), ("val", 1)):
        for month in ("jan", "feb"):
            made = trips(*({"key": f"{month}{i}"} for i in range(n + (month == "feb"))))
            files.write_dataset(made, f"{root}/{split}_{month}", fmt="csv")
    assert rows(feed.ingest_month(spark, root, "jan").select("split", "rows")) == rows(
        spark.createDataFrame([("train", 3), ("val", 1)], "split string, rows long")
    )
    feed.ingest_month(spark, root, "feb")
    assert spark.read.parquet(f"{root}/train_new").count() == 4
    with pytest.raises(ValueError):
        feed.ingest_month(spark, root, "jul")


def test_staged_copy_is_removed(spark):
    df = spark.range(5)
    with staged(df, "t") as copy:
        assert copy.count() == 5
        path = copy.inputFiles()[0]
    assert not __import__("os").path.exists(path.removeprefix("file://"))
    kept = stage(df, "t")
    assert kept.inputFiles()[0].startswith("file:") and shared_dir(spark) in kept.inputFiles()[0]
    remove_folder(spark, kept.inputFiles()[0].rsplit("/", 1)[0])


def test_feed_of_an_empty_month(spark, trips, tmp_path):
    root = str(tmp_path)
    for split in ("train", "val"):
        files.write_dataset(trips({}).filter("fare_amount < 0"), f"{root}/{split}_mar", fmt="csv")
    assert [r.rows for r in feed.ingest_month(spark, root, "mar").collect()] == [0, 0]
