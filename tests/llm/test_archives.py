"""Archives of URLs with blanks and line ends, equal seconds, large pages and one very common page."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from cases import rows_of
from farelane.llm import warc
from farelane.llm.shared import join_classes
from farelane.staging import new_folder

SCHEMA = "page_id long, url string, html string, micros long"


def _frame(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("time", F.timestamp_micros("micros"))
    return df.drop("micros").repartition(parts)


def test_odd_urls_and_equal_seconds_read_back_in_order(spark):
    rng = random.Random(1)
    urls = ["http://x.com/a b", "http://x.com/a%20b", "http://x.com/a\tb", "http://x.com/a\r\nb: c", "http://x.com/a", "http://x.com/%", "http://x.com/a\n", " http://x.com/", "", None, "http://é.com/ü"]
    rows = [(k, rng.choice(urls), f"<p>{k}</p>", 1_500_000_000_000_000 + rng.randint(0, 2_500_000)) for k in range(400)]
    rows += [(None, "http://x.com/a b", "none", 1_500_000_000_000_000), (3, "http://x.com/a b", "again", None)]
    got = warc.archive_pages(_frame(spark, rows), new_folder(spark, "warc")).collect()
    assert len(got) == len(rows) and len({r.run for r in got}) < 20  # many such records in each archive
    order = [(r.url_key, r.date, -1 if r.page_id is None else r.page_id) for r in got]
    assert order == sorted(order)
    assert sorted(map(str, ((r.page_id, r.payload_digest) for r in got))) == sorted(map(str, ((i, sha256(t.encode()).hexdigest()) for i, _, t, _ in rows)))


def test_archives_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "BIG", 1000)
    monkeypatch.setattr(warc, "ARCHIVE", 10_000)
    rows = [(k, f"http://h/{k}", "x" * (k * 100), k) for k in range(60)] + [(100, "http://h/", "y" * 30_000, 0)]
    path = new_folder(spark, "warc")
    got = warc.archive_pages(_frame(spark, rows, 1), path).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for r in got:
        sizes.setdefault(r.run, []).append(r.payload_bytes)
    assert all(len(s) == 1 for s in sizes.values() if max(s) >= 1000)  # 10,000 bytes hold none of the largest
    assert sum(max(s) < 1000 for s in sizes.values()) >= 1


@pytest.mark.parametrize("share", [0.9, 0.3])
def test_a_common_page_is_no_task_of_its_own(spark, share):
    common, n = "c" * 300, 3000
    rows = [(k, f"http://h/{k}", common if k < share * n else f"{k} " * 60, k) for k in range(n)]
    made = warc.records(_frame(spark, rows, 6), "page_id", "url", "html", "time")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 2 * n / len(sizes) and len(sizes) > 2
    assert made.filter("record LIKE '%WARC-Type: revisit%'").count() == share * n - 1


def test_join_with_classes_of_any_size(spark):
    rows = [(k, None if k % 7 == 0 else 1 if k < 600 else k % 50) for k in range(1000)]
    df = spark.createDataFrame(rows, "id long, c int").repartition(4)
    classes = df.filter("c IS NOT NULL AND c <> 5").groupBy("c").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    want = {r.c: r.least for r in classes.collect()}
    got = join_classes(df, classes, "c", "n", {"least": "first"})
    assert rows_of(got) == sorted(((i, c, want.get(c)) for i, c in rows), key=repr)
    assert join_classes(df.limit(0), classes.limit(0), "c", "n", {"least": "first"}).count() == 0
