"""The stages over a small corpus, each against a plain version."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers

import corpus_pipeline
from cases import plain_components, plain_fingerprint
from farelane.llm import contamination, secrets
from test_text_operators import _plain_hits, _toxic_rows


def _folder(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, t, "en", "s", len(t)) for i, t, _ in _toxic_rows(600)]
    words = [f"q{k}" for k in range(500)]
    long = [rng.choice(words) for _ in range(400)]
    for k in range(12):  # near copies
        own = list(long)
        own[k * 7] = "other"
        rows.append((1000 + k, " ".join(own), "en", "s", 0))
    item = " ".join(f"b{k}" for k in range(20))
    rows += [(2000, f"intro {item} end", "en", "s", 1), (2001, f"{item} " + " ".join(words), "en", "s", 1), (2002, "my token=abcdefghijk here now", "en", "s", 29)]
    rows += [(3000, None, "en", "s", None), (3001, "", None, None, 0), (None, "no id at all", "en", "s", 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, y) for i, _, y in _toxic_rows(600)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), docs, item


def test_every_stage_does_what_it_says(spark, tmp_path):
    folder, docs, item = _folder(spark, tmp_path / "in")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = now
        stage(spark, now, folder).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == docs.columns and now.dtypes == docs.dtypes
        kept[name] = (sorted(map(tuple, before.collect()), key=repr), sorted(map(tuple, now.collect()), key=repr))
    before, after = kept["toxicity"]
    lost = {r[0] for r in set(before) - set(after)}
    toxic = {i for i, _, y in _toxic_rows(600) if y}
    assert lost <= toxic and len(lost) > 0.9 * len(toxic)
    before, after = kept["near_copies"]
    prints = [plain_fingerprint(r[1]) for r in before]
    root = plain_components(before, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    least = defaultdict(list)
    for k, r in enumerate(before):
        if r[0] is not None:
            least[root[k]].append(r[0])
    assert {r[0] for r in after if r[0] is not None} == {min(x) for x in least.values()}
    assert any(r[0] is None for r in after)
    before, after = kept["decontamination"]
    bad = {r[0] for r in before if (h := _plain_hits(r[1], [(1, item)]))[1] and 20 * h[1] >= h[0]}
    assert bad == {2000} and {r[0] for r in after} == {r[0] for r in before} - bad
    before, after = kept["secrets"]
    want = [(r[0], secrets.redacted(r[1]), r[2], r[3], len(secrets.redacted(r[1])) if r[1] and secrets.redacted(r[1]) != r[1] else r[4]) for r in before]
    assert after == sorted(want, key=repr) and any("[SECRET]" in (r[1] or "") for r in after)
    assert len(kept["encoding"][1]) == len(after)


def test_run_returns_the_last_stage(spark, tmp_path):
    folder, docs, _ = _folder(spark, tmp_path / "in")
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"} <= set(out.columns) and 0 < out.count() < docs.count()
    assert public_tokenizers.PATTERN and np.all([len(r.ids) == r.n_tokens for r in out.limit(20).collect()])
    assert contamination.WINDOW == 13


def test_one_row_of_each_class_stays_where_ids_repeat(spark):
    text = {k: " ".join(f"{k}{n}" for n in range(80)) for k in "XYZVW"}
    rows = [(3, text["X"]), (3, text["X"]), (5, text["X"]), (5, text["Y"]), (3, text["Z"]), (7, text["V"]), (7, text["V"]), (7, text["W"]), (None, text["X"]), (None, text["X"])]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(4)
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    want = [(3, "X"), (5, "Y"), (3, "Z"), (7, "V"), (7, "W"), (None, "X"), (None, "X")]
    assert got.dtypes == docs.dtypes and sorted(map(tuple, got.collect()), key=repr) == sorted([(i, text[k], "en") for i, k in want], key=repr)
    one = spark.createDataFrame([(1, text["X"], "en"), (1, text["X"], "de"), (2, text["X"], "en")], docs.schema)
    assert [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, one, "").collect()] == [1]
