import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import CLASHING, passages, plain_components, rows_of, table
from farelane.llm import bpe, rollups, suite, vectors, warc
from farelane.llm.graph import components
from farelane.staging import new_folder

# ---------------------------------------------------------------- graph


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 700)] + [(k, 800 + (k - 799) % 30) for k in range(800, 830)]
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges] + [(1, 1), (None, 5), (6, None), (100, 101), (-3, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long").repartition(4)).collect()}
    assert {got[k] for k in range(100, 161)} == {100} and {got[k] for k in range(500, 700)} == {500} and {got[k] for k in range(800, 830)} == {800}
    assert got[7] == got[-3] == -3 and not {1, 5, 6} & set(got)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---------------------------------------------------------------- vectors


def _vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    rows = []
    for k in range(160):
        v = base[rng.integers(0, 40)] + rng.normal(size=16) * rng.choice([0.0, 0.02, 0.05, 0.3])
        rows.append((k, [float(np.float32(x)) for x in v], int(rng.integers(0, 3))))
    rows += [(200 + k, rows[0][1], rows[0][2]) for k in range(12)]
    rows += [
        (300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] + [1.0] * 15, 1), (303, [None] + [1.0] * 15, 1), (304, [float("inf")] + [1.0] * 15, 1),
        (305, rows[0][1], None), (306, [], 1), (307, [1.0, 0.0], 1), (308, [2.0, 0.0], 1), (309, [-1.0, 0.0], 1), (310, [1e-30, 0.0], 1), (0, rows[5][1], rows[5][2]),
        (None, rows[0][1], rows[0][2]), (None, None, None),
    ]
    return rows


def _plain_links(rows):
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) and c is not None for _, v, c in rows]

    def linked(a, b):
        if not (good[a] and good[b]) or rows[a][2] != rows[b][2] or len(rows[a][1]) != len(rows[b][1]):
            return False
        x, y = np.array(rows[a][1]), np.array(rows[b][1])
        return x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98

    count = [sum(linked(a, b) for b in range(len(rows)) if b != a) for a in range(len(rows))]
    root = plain_components(rows, linked)
    least: dict = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(least.get(root[k], i), i)
    return [(i, count[k], least.get(root[k]), i == least.get(root[k])) for k, (i, _, _) in enumerate(rows)]


@pytest.mark.parametrize("slice_size", [2048, 9])
def test_vector_links_equal_brute_force(spark, slice_size):
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.withColumns({c: F.lit(1) for c in CLASHING}).repartition(4)
    assert rows_of(vectors.near_vectors(df, slice_size=slice_size)) == sorted(_plain_links(rows), key=repr)


def test_no_vectors(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_bound_holds_for_every_pair():
    rng = np.random.default_rng(6)
    u = rng.normal(size=(200, 24)) * rng.choice([1e-6, 1, 50], (200, 24))
    u /= np.linalg.norm(u, axis=1)[:, None]
    code, scale, length, error = vectors.quantised(u)
    shown = code * scale[:, None]
    assert (np.linalg.norm(u - shown, axis=1) <= error).all()
    assert (np.abs(u @ u.T - shown @ shown.T) <= length[:, None] * error[None, :] + error[:, None] + 1e-12).all()


# ---------------------------------------------------------------- archives


def _pages():
    body = "<p>" + "é" * 60 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n</p>"
    rows = [(k, f"http://h{k % 5}.example.com/a?q={k % 3}", body if k % 4 == 0 else f"<p>{k}</p>" + "x" * (k * 3)) for k in range(60)]
    rows += [(100, None, None), (101, "http://x/", ""), (102, "not a url\r\nX: y", body), (103, "HTTP://H1.Example.com/a?q=1", "short"), (104, "http://z/", "short")]
    rows += [(0, "http://again/", body), (None, "http://n/", body), (None, "http://n/", "y" * 200), (None, None, "y" * 200), (105, "http://long/", "z" * 300_000)]
    return rows


def test_archives_read_back_whole(spark):
    rows = _pages()
    df = table(spark, [(i, t) for i, _, t in rows], "page_id", "html").limit(0).sparkSession.createDataFrame(rows, "page_id long, url string, html string")
    df = df.withColumns({c: F.lit("e") for c in (*CLASHING, "text", "id", "record", "run", "first", "same")}).withColumn("time", F.timestamp_seconds(F.col("page_id") % 7)).repartition(4)
    path = new_folder(spark, "warc")
    got = warc.archive_pages(df, path)
    least: dict = {}
    for i, _, t in rows:
        if i is not None and len((t or "").encode()) >= 100:
            least[t] = min(least.get(t, i), i)
    want = []
    for i, _, t in rows:
        data = (t or "").encode()
        again = t in least and i != least[t]
        want.append((i, len(data), sha256(data).hexdigest(), "revisit" if again else "response", least[t] if again else None))
    assert rows_of(got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == sorted(want, key=repr)
    order = [(r.url_key, r.date) for r in got.collect()]
    assert order == sorted(order)
    assert got.select("url_key").filter("url_key = 'com,example,h1)/a?q=1'").count() > 3


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string, time timestamp")
    assert warc.archive_pages(df, new_folder(spark, "warc")).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8])
def test_loser_tree_merges(k):
    rng = random.Random(k)
    runs = [sorted(rng.randint(0, 20) for _ in range(rng.randint(0, 30))) for _ in range(k)]
    assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_damage_is_noticed():
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: d\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 8\r\n\r\nHTTP\r\n\r\n\r\n\r\n"))


# ---------------------------------------------------------------- rollups


def _counts(docs):
    return rollups.counted(docs, {"chars": F.length("text"), "words": F.when(F.col("text").isNull(), None).otherwise(F.size(F.split("text", " ")))})


def test_deltas_add_up_in_any_order_and_repetition(spark):
    rows = [(k, None if k == 3 else "ab " * (k % 5), f"s{k % 3}" if k % 7 else None, "en" if k % 2 else "de") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumns({c: F.lit(0) for c in ("tokens", "tokenizer", "e")})
    gone, old = docs.filter("doc_id < 10"), docs.filter("doc_id >= 30")
    new = old.withColumns({"text": F.lit("x y z"), "lang": F.lit("fr")})
    batches = {1: rollups.changes("insert", _counts(docs)), 2: rollups.changes("delete", old=_counts(gone)), 3: rollups.changes("revise", _counts(new), _counts(old))}
    want = rows_of(_counts(docs.filter("doc_id BETWEEN 10 AND 29").unionByName(new)).groupBy("source", "lang", "tokenizer").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens")))
    path = new_folder(spark, "rollup")
    for b in (3, 1, 2, 1, 3):
        rollups.commit(batches[b], path, b)
    assert rows_of(rollups.totals(spark, path).filter("docs <> 0")) == want
    rollups.commit(batches[1].limit(0), path, 4)
    assert rows_of(rollups.totals(spark, path).filter("docs <> 0")) == want
    folded = new_folder(spark, "rollup")
    rollups.compact(spark, path, folded, 2)
    assert rows_of(rollups.totals(spark, folded)) == rows_of(rollups.totals(spark, path))
    for store in (path, folded):  # numbers stay taken
        rollups.commit(batches[1], store, 1)
        with pytest.raises(ValueError):
            rollups.commit(batches[2], store, 1)
        assert rows_of(rollups.totals(spark, store).filter("docs <> 0")) == want
    assert rollups.totals(spark, new_folder(spark, "rollup")).count() == 0


def test_counts_of_empty_tables_and_long_texts(spark):
    docs = spark.createDataFrame([(None, "en", None), ("s", "de", "a1 23 é-b " * 100_000)], "source string, lang string, text string").withColumn("n1", F.lit(1))
    counts = rollups.word_counts(docs.drop("n1"), {"a": suite._words_1, "b": suite._words_2})
    assert rows_of(counts) == sorted([(None, "en", 0, 0), ("s", "de", 300_000, 400_000)], key=repr)
    path = new_folder(spark, "rollup")
    rollups.commit(rollups.changes("insert", rollups.counted(counts.limit(0), {"a": F.col("a")})), path, 1)
    assert rollups.totals(spark, path).count() == 0


def test_german_texts_without_a_source_are_revised(spark, tmp_path):
    rows = [(1, "eins 12 zwei", None, "de"), (2, "drei 45", "src1", "de"), (3, "vier 6", "src3", "de"), (4, "five 7", None, "en"), (5, "sechs 8", "src1", None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = suite.op8_rollups(spark, str(tmp_path)).filter("tokenizer = 'words.1'").select("source", "lang", "docs", "tokens")
    assert rows_of(got) == sorted([(None, "de", 1, 2), ("src1", "de", 1, 1), ("src3", "de", 0, 0), (None, "en", 1, 2), ("src1", None, 1, 2)], key=repr)


def test_counts_of_a_real_tokenizer(spark):
    import public_tokenizers

    docs = spark.createDataFrame([(i, t, "s", "en") for i, t in passages(1, 20) if i is not None], "doc_id long, text string, source string, lang string")
    counts = bpe.tokenize(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = docs.dropDuplicates(["doc_id"]).join(counts.dropDuplicates(["doc_id"]), "doc_id")
    path = new_folder(spark, "rollup")
    rollups.commit(rollups.changes("insert", rollups.counted(rows, {"byte_bpe_50k": F.col("n_tokens")})), path, 1)
    got = rollups.totals(spark, path).first()
    assert (got.docs, got.tokens) == tuple(rows.agg(F.count("*"), F.sum("n_tokens")).first())


def test_lengths_beyond_doubles_link_by_direction(spark):
    tiny = 5e-324
    rows = [(1, [1e200, 1e200], 1), (2, [2e200, 2e200], 1), (3, [1e-200, 1e-200], 1), (4, [tiny, tiny], 1), (5, [1.0, 1.0], 1), (6, [1e200, -1e200], 1), (7, [1e308, 1e-308], 1), (8, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(df).collect()}
    assert got == {**{k: (4, 1) for k in (1, 2, 3, 4, 5)}, 6: (0, 6), 7: (1, 7), 8: (1, 7)}
