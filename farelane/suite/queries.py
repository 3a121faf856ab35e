"""The registered queries: each takes ``(spark, folder)`` and returns a DataFrame.

All read the ``events`` table whole and work on the trips derived from it. Float
results are rounded, so that they can be compared across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.functions import (
    cell_id,
    cell_text,
    clock_date,
    clock_hour,
    cyclic_hour,
    fixed_min_max,
    format_utc,
    geohash,
    haversine_km,
    local_clock,
    manhattan_km,
    one_hot,
    parse_utc,
    to_local,
    weekday,
)
from farelane.operators import chunks, clean, districts, downcast, features, histogram, profile, residuals, summaries
from farelane.operators.quantiles import exact_quantiles
from farelane.plans import evaluate as ev
from farelane.plans import registry, stages
from farelane.plans import train as tr
from farelane.operators.features import to_vector
from farelane.plans.dense import DenseModel, DenseSpec, fit_dense
from farelane.plans.preprocess import preprocess
from farelane.plans.score import fit_distance_line, ml_scorer, score, score_requests, with_utc
from farelane.plans.sync import fit_sync
from farelane.schema import CELLS_20, FEATURE_COLUMNS, MONTHS, RAW, RAW_TEXT, TARGET_COLUMN, WEEKDAYS
from farelane.sources import catalog as cat
from farelane.sources import feed, files, trips
from farelane.sources import quarantine as bad
from farelane.staging import new_folder, stage
from farelane.streaming import fit as stream_training
from farelane.streaming import gate
from farelane.streaming import trips as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r(col: Column | str, places: int = 6) -> Column:
    """Rounded, with minus zero turned into zero."""
    return F.round(F.col(col) if isinstance(col, str) else col, places) + F.lit(0.0)


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return trips.raw_trips(spark, folder)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_trips(raw(spark, folder))


def ends() -> tuple[Column, Column, Column, Column]:
    return F.col("pickup_latitude"), F.col("pickup_longitude"), F.col("dropoff_latitude"), F.col("dropoff_longitude")


def rounded_features(df: DataFrame) -> DataFrame:
    return df.select(*(r(F.col(c).cast("double")).alias(c) for c in df.columns))


def processed(spark: SparkSession, folder: str) -> DataFrame:
    """The processed table, written and read back."""
    path = new_folder(spark, "processed")
    preprocess(raw(spark, folder), path)
    return files.read_processed(spark, path)


def line_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Clean trips with the prediction of the distance line fitted on them."""
    trips_ = stage(cleaned(spark, folder), "clean")
    return score(trips_, fit_distance_line(trips_))


# ---------------------------------------------------------------- sources and sinks


@query
def csv_scan(spark, folder):
    path = new_folder(spark, "csv")
    files.write_dataset(trips.trips_as_text(raw(spark, folder)), path, fmt="csv")
    return files.read_raw(spark, path)


@query
def processed_scan(spark, folder):
    path = new_folder(spark, "processed-csv")
    files.write_dataset(features.with_target(cleaned(spark, folder)), path, fmt="csv")
    return rounded_features(files.read_processed(spark, path, "csv"))


@query
def table_scan(spark, folder):
    path = new_folder(spark, "table")
    loose = raw(spark, folder).withColumns(
        {"fare_amount": F.col("fare_amount").cast("string"), "passenger_count": F.col("passenger_count").cast("long")}
    )
    files.write_dataset(loose, path)
    return files.check_schema(files.conform(spark.read.parquet(path), RAW), RAW)


@query
def chunk_positions(spark, folder):
    placed = chunks.with_chunk_id(raw(spark, folder), ["pickup_datetime", "key"], 2000)
    return placed.select("key", "pickup_datetime", "pos", "chunk_id")


@query
def chunk_slice(spark, folder):
    placed = chunks.with_chunk_id(cleaned(spark, folder), ["pickup_datetime"], 500, distinct_rows=True)
    return chunks.chunk(placed, 250, 500).select("pickup_datetime", "fare_amount", "pos")


@query
def schema_check(spark, folder):
    path = new_folder(spark, "text")
    files.write_dataset(trips.trips_as_text(raw(spark, folder)), path, fmt="csv")
    return files.unreadable_fields(spark.read.option("header", True).csv(path), RAW_TEXT)


@query
def quarantine(spark, folder):
    """Malformed lines with their reasons, and one row that counts the sound ones."""
    path, target = new_folder(spark, "lines"), new_folder(spark, "checked")
    text = trips.trips_as_text(raw(spark, folder))
    number = F.col("key").cast("long")
    line = (
        F.when(number % 97 == 1, F.concat("key", F.lit(",11.5,2013-07-06 17:18:00 UTC")))
        .when(number % 89 == 2, F.concat("key", F.lit(",11.5,2013-07-06 17:18:00 UTC,-73.9,40.7,-73.9,40.7,1,more")))
        .when(number % 83 == 3, F.concat("key", F.lit(",eleven,2013-07-06 17:18:00 UTC,-73.9,40.7,west,40.7,1")))
        .when(number % 211 == 9, F.concat("key", F.lit(",11.5,not a time,-73.9,40.7,-73.9,40.7,1")))
        .otherwise(F.to_csv(F.struct(*RAW.names)))
    )
    text.select(line.alias("value")).write.text(path)
    bad.ingest_checked(spark, path, target)
    sound = bad.read_sound(spark, target).agg(F.lit("").alias("line"), F.lit("sound").alias("reason"), F.lit("").alias("fields"), F.count("*").alias("n"))
    lines = bad.read_quarantined(spark, target).groupBy("line", "reason", F.coalesce("fields", F.lit("")).alias("fields")).agg(F.count("*").alias("n"))
    return lines.unionByName(sound)


@query
def csv_sink(spark, folder):
    path = new_folder(spark, "sink")
    source = cleaned(spark, folder)
    files.write_dataset(source, path, "overwrite", "csv")
    files.write_dataset(source, path, "append", "csv")
    written = spark.read.schema(source.schema).option("header", True).csv(path)
    return written.groupBy("passenger_count").agg(F.count("*").alias("n"), r(F.sum("fare_amount"), 4).alias("fares"))


@query
def table_sink(spark, folder):
    path = new_folder(spark, "sink")
    source = raw(spark, folder).select(
        F.col("passenger_count").alias("0"), F.col("fare_amount").alias("1"), F.col("key").alias("key")
    )
    files.write_dataset(source, path, "overwrite")
    files.write_dataset(source.filter("`0` > 4"), path, "append")
    return spark.read.parquet(path).groupBy("_0").agg(F.count("*").alias("n"), r(F.sum("_1"), 4).alias("fares"))


def _sized_sets(spark, folder, sizes=(("100k", 1),)) -> DataFrame:
    """Train and validation trips, raw and processed, as files with a catalog; a size holds every ``step``-th key."""
    root = new_folder(spark, "sets")
    source = raw(spark, folder)
    key = F.col("key").cast("long")
    entries = []
    for size, step in sizes:
        train, val = ev.split_by_key(source.filter(key % step == 0), key * 7919 % 100)
        for split, rows in (("train", train), ("val", val)):
            path = f"{root}/{cat.dataset_name(split, size, 'raw')}"
            files.write_dataset(rows, path, fmt="csv")
            entries.append((split, size, "raw", "csv", path))
            path = f"{root}/{cat.dataset_name(split, size, 'processed')}"
            preprocess(rows, path)
            entries.append((split, size, "processed", "parquet", path))
    return cat.make_catalog(spark, entries)


@query
def bulk_load(spark, folder):
    sets = _sized_sets(spark, folder, (("500k", 1), ("100k", 2), ("10k", 4), ("1k", 8)))
    loaded = cat.load_sizes(sets, new_folder(spark, "loaded"))
    parts = []
    for e in loaded.collect():
        fare = "fare_amount" if e["zone"] == "raw" else TARGET_COLUMN
        parts.append(
            spark.read.parquet(e["path"]).agg(F.count("*").alias("n"), r(F.sum(F.col(fare).cast("double")), 2).alias("fares"))
            .select(F.lit(e["split"]).alias("split"), F.lit(e["size"]).alias("size"), F.lit(e["zone"]).alias("zone"), "n", "fares")
        )
    return reduce(DataFrame.unionByName, parts)


@query
def catalog_table(spark, folder):
    """Raw trips saved as a catalog table, found through the catalog and read back."""
    name = f"farelane_trips_{uuid.uuid4().hex}"
    files.write_dataset(raw(spark, folder), name, table=True)
    sets = cat.make_catalog(spark, [("train", "new", "raw", "table", name)])
    rows = cat.read_dataset(sets, "train", "new", "raw")
    found = stage(rows.groupBy("passenger_count").agg(F.count("*").alias("n"), r(F.sum("fare_amount"), 4).alias("fares")), "table")
    spark.sql(f"DROP TABLE {name}")
    return found


@query
def processed_months(spark, folder):
    """A processed table written by month: a model fitted on its 66 columns, and the last three months read alone."""
    path = new_folder(spark, "by-month")
    preprocess(raw(spark, folder), path, by_month=True)
    model = tr.fit(files.read_processed(spark, path), "linear")
    late = files.read_processed(spark, path, months=True).filter("year = 2012 AND month >= 10")
    found = tr.predict(late, model).agg(F.count("*").alias("trips"), r(F.avg("fare_amount"), 4).alias("mean_fare"))
    return found.withColumn("columns", F.lit(len(files.read_processed(spark, path).columns)))


@query
def dataset_catalog(spark, folder):
    sets = _sized_sets(spark, folder)
    val = cat.read_dataset(sets, "val", "100k", "raw")
    return val.groupBy("passenger_count").agg(F.count("*").alias("n"), F.max("pickup_datetime").alias("last_pickup"))


@query
def inventory(spark, folder):
    return cat.inventory(_sized_sets(spark, folder))


@query
def monthly_feed(spark, folder):
    root = new_folder(spark, "feed")
    split = F.when(F.col("key").cast("long") * 7919 % 100 >= 30, "train").otherwise("val")
    labelled = raw(spark, folder).withColumns({"split": split, "month": F.month("pickup_datetime")})
    parted = stage(labelled, "months", ["split", "month"])
    loads = []
    for i, month in enumerate(feed.FEED_MONTHS, start=1):
        for part in cat.SPLITS:
            rows = parted.filter((F.col("split") == part) & (F.col("month") == i)).drop("split", "month")
            files.write_dataset(rows, f"{root}/{part}_{month}", fmt="csv")
        loads.append(feed.ingest_month(spark, root, month))
    return reduce(DataFrame.unionByName, loads)


@query
def feed_commit(spark, folder):
    """Six months committed to one store, and each read again from its version."""
    root, store = new_folder(spark, "feed"), new_folder(spark, "feed-store")
    split = F.when(F.col("key").cast("long") * 7919 % 100 >= 30, "train").otherwise("val")
    labelled = raw(spark, folder).withColumns({"split": split, "month": F.month("pickup_datetime")})
    parted = stage(labelled, "months", ["split", "month"])
    versions_ = []
    for i, month in enumerate(feed.FEED_MONTHS, start=1):
        for part in cat.SPLITS:
            rows = parted.filter((F.col("split") == part) & (F.col("month") == i)).drop("split", "month")
            files.write_dataset(rows, f"{root}/{part}_{month}")
        versions_.append(feed.commit_month(spark, root, store, month, "parquet"))
    read = [
        feed.read_feed(spark, store, part, v).groupBy("month").agg(F.count("*").alias("rows"), r(F.sum("fare_amount"), 4).alias("fares"))
        .select(F.lit(v).cast("int").alias("version"), F.lit(part).alias("split"), "month", "rows", "fares")
        for v in versions_ for part in cat.SPLITS
    ]
    return reduce(DataFrame.unionByName, read)


# ---------------------------------------------------------------- cleaning


@query
def drop_key(spark, folder):
    return clean.drop_key(raw(spark, folder))


@query
def drop_duplicates(spark, folder):
    return clean.drop_duplicate_trips(clean.drop_key(raw(spark, folder)))


@query
def drop_missing(spark, folder):
    return clean.drop_missing(raw(spark, folder))


@query
def drop_zero_coordinates(spark, folder):
    return clean.drop_zero_coordinates(raw(spark, folder))


@query
def passengers_above(spark, folder):
    return clean.passengers_above(raw(spark, folder))


@query
def passengers_below(spark, folder):
    return clean.passengers_below(raw(spark, folder))


@query
def fare_above(spark, folder):
    return clean.fare_above(raw(spark, folder))


@query
def fare_below(spark, folder):
    return clean.fare_below(raw(spark, folder))


@query
def latitude_box(spark, folder):
    return clean.in_latitude_box(raw(spark, folder))


@query
def longitude_box(spark, folder):
    return clean.in_longitude_box(raw(spark, folder))


@query
def bbox_wide(spark, folder):
    return clean.in_bbox(cleaned(spark, folder), -74.1, -73.7, 40.6, 40.9)


@query
def bbox_midtown(spark, folder):
    return clean.in_bbox(cleaned(spark, folder), -74.0, -73.95, 40.7, 40.8)


@query
def clean_trips(spark, folder):
    return cleaned(spark, folder)


@query
def cleaning_report(spark, folder):
    return clean.cleaning_report(raw(spark, folder))


@query
def row_counts(spark, folder):
    seen = preprocess(raw(spark, folder), new_folder(spark, "processed"))
    return spark.createDataFrame([(seen.rows, seen.cleaned_rows)], "row_count long, cleaned_row_count long")


@query
def target_split(spark, folder):
    x, y = features.split_target(cleaned(spark, folder))
    fares = y.agg(F.count("*").alias("y_rows"), r(F.sum("fare_amount"), 4).alias("y_sum"), F.lit(len(y.columns)).alias("y_columns"))
    rows = x.agg(F.count("*").alias("x_rows"), r(F.sum("pickup_latitude"), 4).alias("x_sum"), F.lit(len(x.columns)).alias("x_columns"))
    return rows.withColumn("y", fares.select(F.struct("*")).scalar()).select("x_rows", "x_sum", "x_columns", "y.*")


@query
def target_append(spark, folder):
    return rounded_features(features.with_target(cleaned(spark, folder)))


# ---------------------------------------------------------------- time


@query
def parse_pickup(spark, folder):
    text = trips.trips_as_text(raw(spark, folder))
    return text.select(
        "key",
        F.col("pickup_datetime").alias("text"),
        parse_utc(F.col("pickup_datetime")).alias("parsed"),
        parse_utc(F.col("pickup_datetime"), strict=True).alias("parsed_strict"),
    )


@query
def local_time(spark, folder):
    return raw(spark, folder).select("key", "pickup_datetime", to_local(F.col("pickup_datetime")).alias("local"))


@query
def local_parts(spark, folder):
    clock = raw(spark, folder).select("key", local_clock(F.col("pickup_datetime")).alias("c"))
    day = clock_date(F.col("c"))
    return clock.select(
        "key",
        weekday(day).alias("dow"),
        clock_hour(F.col("c")).alias("hour"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
    )


@query
def cyclic_hours(spark, folder):
    hour = clock_hour(local_clock(F.col("pickup_datetime")))
    sin, cos = cyclic_hour(hour)
    return raw(spark, folder).select("key", r(sin).alias("hour_sin"), r(cos).alias("hour_cos"))


@query
def time_features(spark, folder):
    timed = features.time_features(cleaned(spark, folder))
    return timed.select("pickup_datetime", r("hour_sin").alias("hour_sin"), r("hour_cos").alias("hour_cos"), "dow", "month", "year")


@query
def request_times(spark, folder):
    requests = trips.requests_from_events(trips.read_events(spark, folder))
    return with_utc(requests).select("request_id", "pickup_datetime", "status", "utc")


@query
def utc_text(spark, folder):
    return raw(spark, folder).select("key", format_utc(F.col("pickup_datetime")).alias("utc_text"))


@query
def dataset_month(spark, folder):
    source = raw(spark, folder)
    clamped = profile.dataset_month(source.filter(F.year("pickup_datetime") < 2014)).select(F.lit("past").alias("part"), "dataset_month")
    plain = profile.dataset_month(source).select(F.lit("all").alias("part"), "dataset_month")
    return plain.unionByName(clamped).withColumn("dataset_month", F.col("dataset_month").cast("string"))


# ---------------------------------------------------------------- distance, cells, encoding


@query
def haversine(spark, folder):
    return raw(spark, folder).select("key", r(haversine_km(*ends())).alias("haversine_km"))


@query
def manhattan(spark, folder):
    return raw(spark, folder).select("key", r(manhattan_km(*ends())).alias("manhattan_km"))


@query
def geohash_cells(spark, folder):
    lat1, lon1, lat2, lon2 = ends()
    columns = [
        geohash(lat, lon, p).alias(f"{end}_{p}")
        for p in (3, 4, 5)
        for end, lat, lon in (("pickup", lat1, lon1), ("dropoff", lat2, lon2))
    ]
    return raw(spark, folder).select("key", *columns)


@query
def geohash_fine(spark, folder):
    lat1, lon1, _, _ = ends()
    ids = raw(spark, folder).select("key", cell_id(lat1, lon1, 9).alias("id"))
    return ids.select("key", cell_text(F.col("id"), 9).alias("pickup_9"))


@query
def trip_cells(spark, folder):
    return features.with_cells(cleaned(spark, folder)).select("pickup_datetime", "pickup_cell", "dropoff_cell")


@query
def scaled_values(spark, folder):
    timed = features.time_features(features.with_distances(cleaned(spark, folder)))
    return timed.select(
        "pickup_datetime",
        r(fixed_min_max(F.col("passenger_count"), 1, 8)).alias("passengers"),
        r(fixed_min_max(F.col("haversine_km"), 0, 100)).alias("haversine"),
        r(fixed_min_max(F.col("manhattan_km"), 0, 100)).alias("manhattan"),
        r(fixed_min_max(F.col("year"), 2009, 2019)).alias("year"),
        r(fixed_min_max(F.col("fare_amount"), 0, 300)).alias("fare"),
    )


def _as_int(columns: list[Column], names: list[str]) -> list[Column]:
    return [c.cast("int").alias(n) for c, n in zip(columns, names)]


@query
def one_hot_weekday(spark, folder):
    timed = features.time_features(cleaned(spark, folder))
    return timed.select("pickup_datetime", *_as_int(one_hot(F.col("dow"), WEEKDAYS), [f"dow_{d}" for d in WEEKDAYS]))


@query
def one_hot_month(spark, folder):
    timed = features.time_features(cleaned(spark, folder))
    return timed.select("pickup_datetime", *_as_int(one_hot(F.col("month"), MONTHS), [f"month_{m}" for m in MONTHS]))


@query
def one_hot_cells(spark, folder):
    named = features.with_cells(cleaned(spark, folder))
    return named.select(
        "pickup_datetime",
        *_as_int(one_hot(F.col("pickup_cell"), CELLS_20), [f"p_{c}" for c in CELLS_20]),
        *_as_int(one_hot(F.col("dropoff_cell"), CELLS_20), [f"d_{c}" for c in CELLS_20]),
    )


@query
def trip_features(spark, folder):
    return rounded_features(features.trip_features(cleaned(spark, folder)))


@query
def feature_vectors(spark, folder):
    vectors = features.to_vector(features.with_target(cleaned(spark, folder)))
    v = vector_to_array("features")
    return vectors.select(
        F.size(v).alias("width"),
        r(F.aggregate(v, F.lit(0.0), lambda a, b: a + b), 4).alias("total"),
        r("label", 4).alias("label"),
    )


@query
def float_compression(spark, folder):
    narrow = cleaned(spark, folder).select(
        "pickup_datetime", *(F.col(c).cast("float").alias(c) for c in ("fare_amount", *clean.COORDINATES))
    )
    return narrow.select("pickup_datetime", *(r(F.col(c).cast("double")).alias(c) for c in narrow.columns[1:]))


@query
def downcast_plan(spark, folder):
    return downcast.downcast_plan(raw(spark, folder).withColumn("key_number", F.col("key").cast("long")))


@query
def downcast_apply(spark, folder):
    source = stage(raw(spark, folder).withColumn("key_number", F.col("key").cast("long")), "wide")
    small = downcast.apply_downcast(source, downcast.downcast_plan(source))
    return profile.column_info(small)


@query
def preprocess_table(spark, folder):
    return rounded_features(processed(spark, folder))


# ---------------------------------------------------------------- profiling


@query
def describe_trips(spark, folder):
    names = ["fare_amount", *clean.COORDINATES, "passenger_count"]
    found = profile.describe(cleaned(spark, folder), names)
    return found.select("column", "count", *(r(c).alias(c) for c in found.columns[2:]))


@query
def describe_raw(spark, folder):
    found = profile.describe(raw(spark, folder), ["fare_amount", "dropoff_longitude", "passenger_count"])
    return found.select("column", "count", *(r(c).alias(c) for c in found.columns[2:]))


@query
def fare_quantiles(spark, folder):
    found = exact_quantiles(cleaned(spark, folder), ["fare_amount"], [0.01, 0.05, 0.1, 0.5, 0.9, 0.95, 0.99])
    return found.select("column", "prob", r("value").alias("value"))


@query
def column_info(spark, folder):
    return profile.column_info(raw(spark, folder))


@query
def time_range(spark, folder):
    return profile.time_range(cleaned(spark, folder))


def _rounded_bins(hist: DataFrame) -> DataFrame:
    # edges are short decimals divided by the bin count: six places would hit exact halves
    return hist.withColumns({"bin_lo": r("bin_lo", 9), "bin_hi": r("bin_hi", 9)})


@query
def fare_histogram(spark, folder):
    return _rounded_bins(histogram.histogram(cleaned(spark, folder), "fare_amount", 100))


@query
def distance_histogram(spark, folder):
    return _rounded_bins(histogram.histogram(features.with_distance(cleaned(spark, folder)), "distance", 50))


@query
def passenger_counts(spark, folder):
    return profile.value_counts(cleaned(spark, folder), "passenger_count")


@query
def trip_end_union(spark, folder):
    return districts.trip_end_cells(cleaned(spark, folder))


@query
def district_counts(spark, folder):
    return districts.district_counts(cleaned(spark, folder))


@query
def distinct_districts(spark, folder):
    return districts.distinct_districts(cleaned(spark, folder))


@query
def merged_sketches(spark, folder):
    """Sketches of two spans of months, stored one after the other and merged; whether they are as close as promised."""
    rows, path = stage(cleaned(spark, folder), "clean"), new_folder(spark, "sketches")
    early = F.col("pickup_datetime") < F.lit("2014-01-01").cast("timestamp_ntz")
    for part in (early, ~early):
        summaries.put_months(summaries.monthly_sketches(rows.filter(part)), path)
    table = spark.read.parquet(path)
    found = summaries.merged_counts(table).first()
    cells = districts.distinct_districts(rows).first()[0]
    different = rows.select(F.xxhash64(*(c for c in rows.columns if c != "key"))).distinct().count()
    near = lambda estimate, exact: abs(estimate - exact) <= 0.02 * exact
    lines = [("rows", found["rows"], True), ("districts", cells, near(found["districts"], cells)), ("trips", different, near(found["trips"], different))]
    quantiles = summaries.merged_quantiles(table, (0.05, 0.5, 0.95)).collect()
    fare = F.col("fare_amount")
    below = rows.agg(*(F.array(F.count_if(fare < q["value"]), F.count_if(fare <= q["value"])) for q in quantiles)).first()
    for q, (under, upto) in zip(quantiles, below):
        n = found["rows"]
        lines.append((f"fare {q['prob']}", n, under - 0.02 * n <= q["prob"] * n <= upto + 0.02 * n))
    return spark.createDataFrame(lines, "measure string, exact long, close boolean")


@query
def gram_correlation(spark, folder):
    """The correlation matrix from Gram matrices of single months, the newer ones added later."""
    made = stage(features.trip_features(cleaned(spark, folder), keep=("pickup_datetime",), target=True), "features")
    columns, path = [c for c in made.columns if c != "pickup_datetime"], new_folder(spark, "grams")
    early = F.col("pickup_datetime") < F.lit("2014-01-01").cast("timestamp_ntz")
    for part in (early, ~early):
        summaries.put_months(summaries.monthly_grams(made.filter(part), columns, summaries.month(made)), path)
    return summaries.correlations(spark, summaries.total_gram(spark.read.parquet(path)), columns).withColumn("r", r("r", 4))


@query
def top_districts(spark, folder):
    return districts.top_districts(cleaned(spark, folder))


@query
def district_coverage(spark, folder):
    return districts.coverage(cleaned(spark, folder)).withColumn("covered_pct", r("covered_pct"))


@query
def derived_cells(spark, folder):
    trips_ = stage(cleaned(spark, folder), "clean")
    cells = districts.derive_cells(trips_)
    made = features.trip_features(trips_, cells)
    hits = [F.sum(f"_{25 + i}").cast("long") for i in range(2 * len(cells))]
    named = [
        F.struct(F.lit(i + 1).alias("rank"), F.lit(c).alias("cell"), hits[i].alias("pickups"), hits[len(cells) + i].alias("dropoffs"))
        for i, c in enumerate(cells)
    ]
    return made.agg(F.array(*named).alias("rows")).select(F.inline("rows"))


@query
def distance_correlation(spark, folder):
    found = profile.correlation(features.with_distance(cleaned(spark, folder)), "distance", "fare_amount").first()
    p = profile.pearson_p_value(found.r, found.n)
    rows = spark.createDataFrame([(found.r, found.n, p < 1e-6)], "r double, n long, significant boolean")
    return rows.withColumn("r", r("r"))


@query
def correlation_matrix(spark, folder):
    made = features.with_target(cleaned(spark, folder))
    return profile.corr_long(made, made.columns).withColumn("r", r("r", 4))


@query
def feature_boxes(spark, folder):
    found = profile.box_stats(features.trip_features(cleaned(spark, folder)), FEATURE_COLUMNS)
    numbers = [c for c in found.columns if c not in ("column", "outliers")]
    return found.select("column", "outliers", *(r(c).alias(c) for c in numbers))


@query
def fare_line(spark, folder):
    found = profile.fit_line(features.with_distance(cleaned(spark, folder)), "distance", "fare_amount")
    return found.select(*(r(c).alias(c) for c in ("slope", "intercept", "r2")), "n")


@query
def density_grid(spark, folder):
    return histogram.density_grid(cleaned(spark, folder), -74.1, -73.7, 40.6, 40.9, 40, 30)


@query
def head_trips(spark, folder):
    return profile.head_sorted(raw(spark, folder), 5, "pickup_datetime", "key")


# ---------------------------------------------------------------- residuals


@query
def residual_summary(spark, folder):
    found = residuals.residual_summary(line_scored(spark, folder))
    return found.select("column", "count", *(r(c).alias(c) for c in found.columns[2:]))


@query
def residual_bands(spark, folder):
    found = residuals.residual_bands(line_scored(spark, folder))
    return found.select("side", "band", "n", r("mean_residual", 4).alias("mean_residual"), r("mae", 4).alias("mae"))


@query
def prediction_histogram(spark, folder):
    return _rounded_bins(histogram.pred_truth_hist(line_scored(spark, folder), 200))


@query
def residual_histogram(spark, folder):
    scored = residuals.residuals(line_scored(spark, folder))
    return _rounded_bins(histogram.histogram(scored, "residual", 40, -20.0, 20.0, outside=True))


@query
def sorted_residuals(spark, folder):
    return residuals.sort_residuals(line_scored(spark, folder)).select("pickup_datetime", r("residual").alias("residual"))


@query
def worst_residuals(spark, folder):
    found = residuals.worst_k(line_scored(spark, folder), 5)
    return found.select("band", "rank", "pickup_datetime", "fare_amount", r("residual").alias("residual"))


# ---------------------------------------------------------------- models


@query
def train_test_split(spark, folder):
    train, test = ev.split_by_key(raw(spark, folder), F.col("key").cast("long") * 7919 % 100)
    return train.select("key", F.lit("train").alias("part")).unionByName(test.select("key", F.lit("test").alias("part")))


@query
def cross_validation(spark, folder):
    trips_ = stage(features.with_distance(cleaned(spark, folder)), "clean")
    found = ev.cv_linear_mae(trips_, "distance", "fare_amount", F.minute("pickup_datetime") % 5)
    return found.select("fold", *(r(c).alias(c) for c in ("slope", "intercept", "mae")), "rows")


@query
def evaluate_line(spark, folder):
    found = ev.evaluate(line_scored(spark, folder))
    return found.select(r("loss", 4).alias("loss"), r("mae", 4).alias("mae"), "rows")


@query
def evaluate_by_month(spark, folder):
    found = ev.evaluate(line_scored(spark, folder), [F.year("pickup_datetime").alias("year"), F.month("pickup_datetime").alias("month")])
    return found.select("year", "month", r("loss", 4).alias("loss"), r("mae", 4).alias("mae"), "rows")


@query
def evaluate_by_band(spark, folder):
    found = ev.evaluate(line_scored(spark, folder), [residuals.band_of(F.col("fare_amount")).alias("band")])
    return found.select("band", r("loss", 4).alias("loss"), r("mae", 4).alias("mae"), "rows")


@query
def score_trips(spark, folder):
    return line_scored(spark, folder).select("pickup_datetime", "fare_amount", r("prediction").alias("prediction"))


@query
def scored_requests(spark, folder):
    line = fit_distance_line(cleaned(spark, folder))
    requests = trips.requests_from_events(trips.read_events(spark, folder))
    return score_requests(requests, line).select("request_id", "status", r("fare").alias("fare"))


@query
def request_features(spark, folder):
    requests = with_utc(trips.requests_from_events(trips.read_events(spark, folder)))
    safe = requests.filter("status = 'ok'").withColumn("pickup_datetime", F.col("utc"))
    made = features.trip_features(safe, keep=("request_id",))
    return made.select("request_id", *(r(F.col(c).cast("double")).alias(c) for c in FEATURE_COLUMNS))


def _yearly_runs(spark, folder) -> DataFrame:
    """One run row per pickup year: even years as evaluations, odd ones as trainings."""
    found = ev.evaluate(
        line_scored(spark, folder).withColumn("year", F.year("pickup_datetime")), ["year"]
    )
    return found.select(
        F.concat(F.lit("run-"), F.col("year")).alias("run_id"),
        F.make_timestamp(F.col("year"), F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)).alias("ts"),
        F.when(F.col("year") % 2 == 0, "evaluate").otherwise("train").alias("context"),
        F.create_map(F.lit("year"), F.col("year").cast("string"), F.lit("rows"), F.col("rows").cast("string")).alias("params"),
        F.create_map(F.lit("mae"), F.col("mae"), F.lit("loss"), F.col("loss")).alias("metrics"),
    )


@query
def run_log(spark, folder):
    root = new_folder(spark, "runs")
    registry.append_runs(_yearly_runs(spark, folder), root)
    return registry.read_runs(spark, root).select(
        "run_id",
        "context",
        F.col("params")["year"].alias("year"),
        F.col("params")["rows"].alias("row_count"),
        r(F.col("metrics")["mae"], 4).alias("mae"),
    )


@query
def run_comparison(spark, folder):
    return registry.compare_runs(_yearly_runs(spark, folder))


def _monthly_models(spark, folder) -> DataFrame:
    """A models table with one version per pickup month."""
    month = cleaned(spark, folder).select(F.year("pickup_datetime").alias("y"), F.month("pickup_datetime").alias("m"))
    version = (F.col("y") * 100 + F.col("m")).cast("int")
    return (
        month.groupBy("y", "m")
        .agg(F.count("*").alias("n"))
        .select(
            F.concat(F.lit("fare-"), F.col("m") % 3).alias("name"),
            version.alias("version"),
            F.when(F.col("n") % 2 == 0, "Production").otherwise("Staging").alias("stage"),
            F.lit("linear").alias("kind"),
            F.concat(F.lit("models/"), version).alias("path"),
            F.lit(0).alias("seq"),
        )
    )


@query
def stage_lookup(spark, folder):
    models = stage(_monthly_models(spark, folder), "models")
    both = [registry.latest_versions(models, s).withColumn("stage", F.lit(s)) for s in ("Production", "Staging")]
    return both[0].unionByName(both[1])


#: Rate of the networks below; all else are the defaults: 100 rounds at most, patience 2.
NETWORK = DenseSpec(learning_rate=0.005)
#: Rows of a chunk, the default of the library that chunks exist for.
CHUNK_ROWS = 2000


def _fit_sets(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Processed trips to learn from and to test on, by the minute of the pickup."""
    held = F.minute("pickup_datetime") % 10 < 3
    rows = stage(features.trip_features(cleaned(spark, folder).withColumn("held", held), keep=("held",), target=True), "fit")
    return rows.filter("NOT held").drop("held"), rows.filter("held").drop("held")


def _mean_mae(train: DataFrame, held: DataFrame) -> tuple[int, int, float]:
    """(rows, held rows, error on the held rows of predicting the mean fare)."""
    fare = F.col(TARGET_COLUMN).cast("double")
    n, mean = train.agg(F.count("*"), F.avg(fare)).first()
    m, mae = held.agg(F.count("*"), F.avg(F.abs(fare - F.lit(mean)))).first()
    return n, m, mae


def _report(spark, name: str, train: DataFrame, held: DataFrame, mae: float) -> DataFrame:
    n, m, mean_mae = _mean_mae(train, held)
    rows = spark.createDataFrame(
        [(name, n, m, mean_mae, mae < mean_mae)], "model string, train_rows long, held_rows long, mean_mae double, beats_mean boolean"
    )
    return rows.withColumn("mean_mae", r("mean_mae", 3))


@query
def linear_fit(spark, folder):
    """Least squares: residuals add up to nothing, alone and weighted by each real-valued feature."""
    rows = stage(features.with_target(cleaned(spark, folder)), "fit")
    model = tr.fit(rows, "linear")
    scored = model.transform(to_vector(rows))
    left = F.col("prediction") - F.col("label")
    return scored.select(left.alias("e"), vector_to_array("features").alias("x")).agg(
        F.count("*").alias("rows"), r(F.avg("e"), 3).alias("residual"),
        *(r(F.avg(F.col("e") * F.col("x")[k]), 3).alias(f"with_{k}") for k in (0, 20, 21, 22, 23, 24)),
    )


@query
def linear_scored_trips(spark, folder):
    """Raw clean trips scored by the linear model: a flag column per month makes the means of each month agree."""
    model = tr.fit(stage(features.with_target(cleaned(spark, folder)), "fit"), "linear")
    scored = score(cleaned(spark, folder), ml_scorer(model))
    return scored.groupBy(F.month(clock_date(local_clock(F.col("pickup_datetime")))).alias("month")).agg(
        F.count("*").alias("trips"), r(F.avg("prediction"), 2).alias("mean_prediction")
    )


@query
def pipeline_scored(spark, folder):
    """Raw trips scored by a stored pipeline of cleaning, features and linear model; the means of each month agree."""
    path, source = new_folder(spark, "pipeline"), raw(spark, folder)
    stages.fit_pipeline(source).save(path)
    scored = PipelineModel.load(path).transform(source)
    return scored.groupBy(F.month(clock_date(local_clock(F.col("pickup_datetime")))).alias("month")).agg(
        F.count("*").alias("trips"), r(F.avg("prediction"), 2).alias("mean_prediction")
    )


@query
def tree_fit(spark, folder):
    train, held = _fit_sets(spark, folder)
    return _report(spark, "gbt", train, held, ev.evaluate(tr.predict(held, tr.fit(train, "gbt", held))).first().mae)


@query
def dense_fit(spark, folder):
    train, held = _fit_sets(spark, folder)
    model = tr.fit(train, "dense", held, spec=NETWORK)
    return _report(spark, "dense", train, held, ev.evaluate(tr.predict(held, model)).first().mae)


def _fixed_network() -> DenseModel:
    """A small network whose weights are whole-number arithmetic, the same in SQL."""
    spec = DenseSpec(hidden=(2,))
    n = spec.inputs
    first = [[((7 * i + 3 * j) % 11 - 5) / 8 for j in range(2)] for i in range(n)]
    layers = [
        [np.ones(n), np.zeros(n), np.zeros(n), np.full(n, 1 - 1e-3), np.array(first), np.array([0.25, -0.5])],
        [np.ones(2), np.zeros(2), np.zeros(2), np.full(2, 1 - 1e-3), np.array([[1.5], [2.5]]), np.array([3.0])],
    ]
    return DenseModel(spec, np.concatenate([p.ravel() for layer in layers for p in layer]))


@query
def dense_scored(spark, folder):
    """Raw clean trips scored by a network."""
    scored = score(cleaned(spark, folder), ml_scorer(_fixed_network()))
    return scored.select("pickup_datetime", "fare_amount", r("prediction", 3).alias("prediction"))


@query
def dense_requests(spark, folder):
    """Requests scored by a network; some of them miss a field."""
    i = F.col("request_id")
    requests = trips.requests_from_events(trips.read_events(spark, folder)).withColumns({
        "pickup_latitude": F.when(i % 31 != 1, F.col("pickup_latitude")),
        "dropoff_longitude": F.when(i % 37 == 2, F.lit(float("nan"))).otherwise(F.col("dropoff_longitude")),
        "passenger_count": F.when(i % 41 != 3, F.col("passenger_count")),
        "pickup_datetime": F.when(i % 43 != 4, F.col("pickup_datetime")),
    })
    return score_requests(requests, ml_scorer(_fixed_network())).select("request_id", "status", r("fare", 3).alias("fare"))


@query
def chunked_fit(spark, folder):
    train, held = _fit_sets(spark, folder)
    placed = chunks.with_chunk_id(train, FEATURE_COLUMNS[20:25], CHUNK_ROWS)
    _, lines = tr.fit_chunks(placed, held, spec=NETWORK)
    mean_mae = _mean_mae(train, held)[2]
    return lines.select("chunk_id", "rows", (F.col("val_mae") < mean_mae).alias("beats_mean"))


@query
def warm_start(spark, folder):
    """A network that goes on from a stored one begins ahead of a new one."""
    train, held = _fit_sets(spark, folder)
    path = new_folder(spark, "network")
    cold = fit_dense(train, held, spec=NETWORK, epochs=3)
    cold.save(path)
    warm = fit_dense(train, held, warm=DenseModel.load(spark, path), epochs=1)
    ahead = warm.history[0]["train_loss"] < cold.history[0]["train_loss"]
    return spark.createDataFrame([(train.count(), ahead)], "rows long, ahead boolean")


@query
def sync_fit(spark, folder):
    """Steps in common over eighths of the table, left after two passes and taken up again from the ledger."""
    train, held = _fit_sets(spark, folder)
    rows, path = train.count(), new_folder(spark, "ledger")
    spec = DenseSpec(learning_rate=0.02, batch_size=max(1, rows // 8))
    fit_sync(train, held, spec=spec, epochs=2, patience=4, workers=2, ledger=path)
    passes = fit_sync(train, held, spec=spec, epochs=4, patience=4, workers=2, ledger=path).history
    falls = passes[-1]["train_loss"] < passes[0]["train_loss"]
    return spark.createDataFrame([(rows, [p["epoch"] for p in passes] == [0, 1, 2, 3], falls)], "rows long, four_passes boolean, falls boolean")


@query
def model_store(spark, folder):
    """The model in production is evaluated before its successor is trained, which waits outside production."""
    root = new_folder(spark, "store")
    train, held = _fit_sets(spark, folder)
    tr.train(train, held, root, kind="linear")
    registry.promote(spark, root, "fare", 1)
    tr.evaluate_production(held, root)
    tr.train(train, held, root, kind="gbt")
    models, runs = registry.read_models(spark, root), registry.read_runs(spark, root)
    found = registry.compare_runs(runs).first()
    n, m, mean_mae = _mean_mae(train, held)
    return spark.createDataFrame(
        [(
            registry.model_version(models, "fare"), registry.model_version(models, "fare", "None"), runs.count(), n, m,
            max(found.eval_mae, found.train_mae) < mean_mae, found.delta != 0, found.improved == (found.train_mae < found.eval_mae),
        )],
        "in_production int, newest int, runs long, train_rows long, held_rows long, beat_mean boolean, differ boolean, consistent boolean",
    )


# ---------------------------------------------------------------- streams


def _run(query_) -> None:
    query_.awaitTermination()


def _land(sdf: DataFrame, label: str) -> DataFrame:
    spark = sdf.sparkSession
    path = new_folder(spark, label)
    _run(streams.start(sdf, path, f"{path}-state"))
    return spark.read.schema(sdf.schema).parquet(path)


def stream_trips(spark, folder) -> DataFrame:
    return trips.trips_from_events(trips.stream_events(spark, folder))


def arrivals(spark, parts: list[DataFrame]) -> DataFrame:
    """A stream that brings the parts one after another, each as the files of all tasks that have some of it."""
    path = new_folder(spark, "arrivals")
    for rows in parts:
        rows.write.mode("append").parquet(path)
    many = len(spark.read.schema(RAW).parquet(path).inputFiles())
    return spark.readStream.schema(RAW).option("maxFilesPerTrigger", max(1, -(-many // len(parts)))).parquet(path)


def shuffled_trips(spark, folder, n: int = 5) -> DataFrame:
    """Trips as a stream whose order has nothing to do with the pickup time."""
    rows = raw(spark, folder)
    place = F.pmod(F.xxhash64("key", "fare_amount"), F.lit(n))
    # copies of a trip come again with a later file
    return arrivals(spark, [*(rows.filter(place == k) for k in range(n)), rows.filter(F.col("passenger_count") == 3)])


def delayed_trips(spark, folder) -> DataFrame:
    """Trips in pickup order with a day's disorder; trips of 3 passengers come again with the next arrival, those of 5 once, a month late, and those of 2 again at the end."""
    rows = raw(spark, folder).withColumn("day", F.date_diff("pickup_datetime", F.lit("1970-01-01").cast("date")))
    rows = stage(rows.withColumn("place", F.col("day") + F.pmod(F.xxhash64("key"), F.lit(2)).cast("int")), "delayed")
    low, high = rows.agg(F.min("place"), F.max("place")).first()
    width = max(1, -(-(high - low + 1) // 6))
    at = F.floor((F.col("place") - low) / width)
    parts = []
    for k in range(8):
        own = rows.filter((at == k) & ~F.col("passenger_count").eqNullSafe(5)) if k < 6 else rows.limit(0)
        again = rows.filter((at == k - 1) & (F.col("passenger_count") == 3))
        late = rows.filter((at == k - 2) & (F.col("passenger_count") == 5))
        parts.append(own.unionByName(again).unionByName(late))
    parts.append(rows.filter(F.col("passenger_count") == 2).unionByName(rows.filter("place IS NULL")))
    return arrivals(spark, [p.select(RAW.names) for p in parts])


@query
def stream_features(spark, folder):
    return rounded_features(_land(streams.stream_features(stream_trips(spark, folder)), "stream-features"))


@query
def stream_dedup(spark, folder):
    path = new_folder(spark, "stream-dedup")
    source = shuffled_trips(spark, folder)
    _run(streams.stream_dedup(source, path, f"{path}-state", period="yyyy"))
    return streams.read_deduped(spark, path, source.schema)


@query
def stream_error(spark, folder):
    line = fit_distance_line(cleaned(spark, folder))
    path = new_folder(spark, "stream-error")
    _run(streams.stream_error(shuffled_trips(spark, folder), line, path, f"{path}-state"))
    return streams.read_error(spark, path).select(
        F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"), r("mae", 4).alias("mae"), "rows"
    )


@query
def stream_dedup_state(spark, folder):
    path = new_folder(spark, "dedup-state")
    source = delayed_trips(spark, folder)
    _run(gate.dedup_within(source, path, f"{path}-state", "400 days", period="yyyy"))
    return gate.read_within(spark, path, source.schema)


@query
def stream_error_window(spark, folder):
    line = fit_distance_line(cleaned(spark, folder))
    path = new_folder(spark, "error-window")
    _run(gate.error_windows(delayed_trips(spark, folder), line, path, f"{path}-state"))
    return gate.read_windows(spark, path, f"{path}-state").select(
        F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"), r("mae", 4).alias("mae"), "rows"
    )


@query
def stream_refresh(spark, folder):
    path = new_folder(spark, "refresh")
    for _ in range(2):  # the second run finds nothing new
        _run(streams.start(clean.filter_trips(stream_trips(spark, folder)), path, f"{path}-state"))
    landed = spark.read.parquet(path)
    return landed.groupBy("passenger_count").agg(F.count("*").alias("n"), r(F.sum("fare_amount"), 4).alias("fares"))


@query
def stream_fit(spark, folder):
    """A network that goes on with each of several batches; every stored version names its batch."""
    root = new_folder(spark, "stream-fit")
    train, held = _fit_sets(spark, folder)
    feed_ = streams.stream_features(shuffled_trips(spark, folder, 2))
    _run(stream_training.stream_fit(feed_, held, root, f"{root}/state", spec=NETWORK))
    mean_mae = _mean_mae(train, held)[2]
    return registry.read_runs(spark, root).select("run_id", "context", (F.col("metrics")["mae"] < mean_mae).alias("beats_mean"))


# ---------------------------------------------------------------- flagship


@query
def weekday_fares(spark, folder):
    """Clean trips by local weekday: count, average fare and distance."""
    named = features.time_features(features.with_distances(cleaned(spark, folder)))
    return named.groupBy("dow").agg(
        F.count("*").alias("trips"),
        r(F.avg("fare_amount"), 4).alias("avg_fare"),
        r(F.avg("haversine_km"), 4).alias("avg_km"),
    )
