"""Commits seen whole or not at all, version numbers claimed once, malformed lines set aside."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from farelane.plans import registry
from farelane.schema import RAW, RAW_TEXT
from farelane.sources import feed, quarantine, versions
from farelane.sources.catalog import SPLITS
from farelane.sources.files import write_dataset
from farelane.staging import create_new, names_in, read_small


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int").coalesce(1)


def read(spark, store, name, version=None):
    return sorted(r.n for r in versions.read_version(spark, store, name, version).collect())


def test_a_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "a" / "claim")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: create_new(spark, path, f"writer {k}"), range(16)))
    assert won.count(True) == 1 and read_small(spark, path) == f"writer {won.index(True)}"
    assert names_in(spark, str(tmp_path / "a")) == ["claim"] and names_in(spark, str(tmp_path / "none")) == []


def test_replace_append_and_time_travel(spark, tmp_path):
    store = str(tmp_path)
    assert versions.commit(spark, store, {"a": numbers(spark, 1), "b": numbers(spark, 9)}) == 1
    assert versions.commit(spark, store, {"a": numbers(spark, 2, 3)}, "append") == 2
    opened = versions.read_version(spark, store, "a")
    assert versions.commit(spark, store, {"a": numbers(spark, 4)}) == 3
    assert [read(spark, store, "a", v) for v in (None, 1, 2, 3)] == [[4], [1], [1, 2, 3], [4]]
    assert sorted(r.n for r in opened.collect()) == [1, 2, 3]  # a reader keeps what it has opened
    assert read(spark, store, "b") == [9]
    with pytest.raises(versions.Conflict):
        versions.commit(spark, store, {"a": numbers(spark, 5)}, base=2)
    assert versions.commit(spark, store, {"b": numbers(spark, 5)}, base=1) == 4
    for missing in (("c", None), ("a", 7)):
        with pytest.raises(LookupError):
            versions.read_version(spark, store, *missing)
    assert len(versions.expire(spark, store, keep=1)) == 4 and versions.versions(spark, store) == [4]
    assert read(spark, store, "a") == [4] and read(spark, store, "b") == [5]


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    store = str(tmp_path)
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda k: versions.commit(spark, store, {"a": numbers(spark, k)}, "append"), range(8)))
    assert sorted(got) == list(range(1, 9)) and read(spark, store, "a") == list(range(8))


def months(spark, trips, root):
    for k, month in enumerate(("jan", "feb"), start=1):
        for split in SPLITS:
            write_dataset(trips(*({"fare_amount": float(10 * k + j)} for j in range(k + len(split)))), f"{root}/{split}_{month}")


def test_a_month_changes_both_sets_or_none(spark, trips, tmp_path, monkeypatch):
    root, store = str(tmp_path / "in"), str(tmp_path / "store")
    months(spark, trips, root)
    assert feed.commit_month(spark, root, store, "jan", "parquet") == 1
    seen = lambda: {s: {(r.month, r.n) for r in feed.read_feed(spark, store, s).groupBy("month").agg(F.count("*").alias("n")).collect()} for s in SPLITS}
    january = {"train": {("jan", 6)}, "val": {("jan", 4)}}
    assert seen() == january
    write, done = versions.write_dataset, []

    def dies(*args, **kwargs):
        if done:
            raise RuntimeError("lost")
        done.append(write(*args, **kwargs))

    monkeypatch.setattr(versions, "write_dataset", dies)  # between the two writes
    with pytest.raises(RuntimeError):
        feed.commit_month(spark, root, store, "feb", "parquet")
    monkeypatch.setattr(versions, "write_dataset", write)
    assert seen() == january

    def lost(*args):
        raise RuntimeError("lost")

    claim = versions.create_new
    monkeypatch.setattr(versions, "create_new", lost)  # before the manifest
    with pytest.raises(RuntimeError):
        feed.commit_month(spark, root, store, "feb", "parquet")
    monkeypatch.setattr(versions, "create_new", claim)
    assert seen() == january
    assert feed.commit_month(spark, root, store, "feb", "parquet") == 2
    assert seen() == {"train": {("feb", 7)}, "val": {("feb", 5)}}
    assert feed.read_feed(spark, store, "train", 1).count() == 6
    assert len(versions.expire(spark, store)) == 3  # what the two lost commits had written
    assert feed.read_feed(spark, store, "train", 1).count() == 6
    with pytest.raises(ValueError):
        feed.commit_month(spark, root, store, "dec")


class Stored:
    """A model that only writes its path."""

    def save(self, path):
        self.path = path


def test_savers_at_the_same_time_get_different_versions(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda _: registry.save_model(spark, root, "fare", Stored(), "linear")[0], range(6)))
    assert sorted(got) == list(range(1, 7))
    kept = registry.read_models(spark, root)
    assert kept.count() == 6 and kept.select("path").distinct().count() == 6
    create_new(spark, f"{root}/claims/fare/{7:06d}")  # its saver died
    assert registry.save_model(spark, root, "fare", Stored(), "linear")[0] == 8


LINES = {
    "a,11.0,2013-07-06 17:18:00 UTC,-73.95,40.78,-73.98,40.76,1": None,
    'a "b",11.0,2013-07-06 17:18:00 UTC,-73.95,40.78,-73.98,40.76,1': None,
    '"a,b",11.0,2013-07-06 17:18:00,-73.95,40.78,-73.98,40.76,2': None,
    "empty,,,,,,,": None,
    "short,11.0,2013-07-06 17:18:00 UTC": ("short", None),
    "one": ("short", None),
    "long,11.0,2013-07-06 17:18:00 UTC,-73.95,40.78,-73.98,40.76,1,2,3": ("long", None),
    "long,11.0,2013-07-06 17:18:00 UTC,-73.95,40.78,-73.98,40.76,1,": ("long", None),
    "fare,x,2013-07-06 17:18:00 UTC,-73.95,40.78,-73.98,40.76,1": ("unreadable", "fare_amount"),
    "byte,1.0,2013-07-06 17:18:00 UTC,-73.95,40.78,-73.98,40.76,1000": ("unreadable", "passenger_count"),
    "time,1.0,yesterday,-73.95,40.78,-73.98,north,1": ("unreadable", "pickup_datetime,dropoff_latitude"),
}


def test_malformed_lines_are_quarantined_with_file_and_reason(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    header = ",".join(RAW_TEXT.names)
    for k in range(2):
        (source / f"{k}.csv").write_text("\n".join([header, *list(LINES)[k::2], "", "  "]) + "\n")
    quarantine.ingest_checked(spark, str(source), target)
    bad = {r.line: (r.reason, r.fields, r.file.rsplit("/", 1)[-1]) for r in quarantine.read_quarantined(spark, target).collect()}
    assert bad == {line: (*why, f"{k % 2}.csv") for k, (line, why) in enumerate(LINES.items()) if why}
    sound = quarantine.read_sound(spark, target)
    assert sound.schema.simpleString() == RAW.simpleString()
    assert sorted(r.key for r in sound.collect()) == ["a", 'a "b"', "a,b", "empty"]
    assert sound.filter("key = 'a' AND fare_amount = 11.0 AND passenger_count = 1 AND pickup_datetime = TIMESTAMP_NTZ '2013-07-06 17:18:00'").count() == 1


def test_no_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.csv").write_text(",".join(RAW_TEXT.names) + "\n")
    quarantine.ingest_checked(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert quarantine.read_sound(spark, str(tmp_path / "out")).count() == 0 == quarantine.read_quarantined(spark, str(tmp_path / "out")).count()
