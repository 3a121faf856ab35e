"""FTRL against a plain loop over dictionaries, and one rule at every size."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import CLASHING
from farelane.llm import toxicity


def plain_ftrl(rows, labels, spec, seed):
    """(weights by key, bias) with one pass per row and coordinate."""
    z, n = {}, {}
    scale = min(1.0, len(rows) * spec.shards / spec.sample) ** 0.5

    def weight(key):
        l1 = 0.0 if key == "bias" else spec.l1 * scale
        v = z.get(key, 0.0)
        if abs(v) <= l1:
            return 0.0
        return (math.copysign(l1, v) - v) / ((spec.beta + math.sqrt(n.get(key, 0.0))) / spec.alpha + spec.l2)

    order = np.random.default_rng(seed)
    for _ in range(spec.epochs):
        for r in order.permutation(len(rows)):
            keys = [*rows[r].tolist(), "bias"]
            w = {k: weight(k) for k in keys}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - labels[r]
            for k in keys:
                before = n.get(k, 0.0)
                n[k] = before + g * g
                z[k] = z.get(k, 0.0) + g - (math.sqrt(n[k]) - math.sqrt(before)) / spec.alpha * w[k]
    final = {k: weight(k) for k in z}
    bias = final.pop("bias", 0.0)
    return {k: w for k, w in final.items() if w}, bias


@pytest.mark.parametrize("size", [1, 3, 4, 39, 41, 300])
def test_weights_equal_a_plain_loop(size):
    rng = random.Random(size)
    labels = np.array([float(rng.random() < 0.4) for _ in range(size)])
    rows = [np.array(sorted({rng.randint(0, 40) for _ in range(8)} | ({100} if y else {200})), np.uint32) for y in labels]
    spec = toxicity.Spec(sample=600, l1=0.5)
    keys, weights, bias = toxicity.ftrl(rows, labels, spec, 7)
    want, want_bias = plain_ftrl(rows, labels, spec, 7)
    assert {int(k): pytest.approx(w, abs=1e-9) for k, w in zip(keys, weights)} == want and bias == pytest.approx(want_bias, abs=1e-9)


@pytest.mark.parametrize("border", [99, 199, 399])
def test_no_size_changes_the_rule(border):
    spec = toxicity.Spec(sample=400, l1=1.0)
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 30, 6)).astype(np.uint32) for _ in range(border + 3)]
    labels = np.array([float(5 in r) for r in rows])
    biases = [toxicity.ftrl(rows[:k], labels[:k], spec, 0)[2] for k in range(border - 2, border + 3)]
    assert max(abs(a - b) for a, b in zip(biases, biases[1:])) < 1.5


def test_few_labels_long_texts_and_clashing_columns(spark):
    text = F.when(F.col("doc_id") % 3 == 0, "vile words here").otherwise("kind words there")
    docs = spark.range(60).select(F.col("id").alias("doc_id")).withColumn("text", text).withColumns({c: F.lit(c) for c in (*CLASHING, "d", "y", "f", "shard")})
    docs = docs.unionByName(docs.limit(1).withColumns({"doc_id": F.lit(1000).cast("long"), "text": F.repeat(F.lit("vile kind "), 200_000)}))
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels, spec=toxicity.Spec(l1=0.1))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == 61 and all(got[k].predicted == (k % 3 == 0) for k in range(60)) and 0 <= got[1000].score <= 1
    empty = labels.limit(0)
    assert {r.predicted for r in toxicity.score(docs, toxicity.fit(docs, empty)).collect()} == {0}
    assert toxicity.score(docs.limit(0), model).count() == 0
