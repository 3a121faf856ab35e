"""Embedding near-duplicates: int8 tile products with error bounds, full precision for what may link."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.graph import Forest, components
from farelane.llm.shared import cut, join_classes

#: Distinct vectors of a slice; a tile is the product of two slices of one label.
SLICE = 2048
#: Rows of a tile that are multiplied at once.
STRIP = 512


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scales, lengths, errors) of unit vectors: ``unit = scale * code + e`` with ``|e| <= error``.

    ``lengths`` are those of ``scale * code``. Both are rounded up by more than the
    arithmetic can lose.
    """
    scale = np.abs(unit).max(axis=1) / 127.0
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    shown = code * scale[:, None]
    slack = 1 + 1e-12
    return code, scale, np.linalg.norm(shown, axis=1) * slack, np.linalg.norm(unit - shown, axis=1) * slack + 1e-15


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors over powers of two that bring their largest entries between one half and one, so that no square is lost."""
    _, power = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -power[:, None])


def tile_links(a: np.ndarray, b: np.ndarray | None, threshold: float):
    """Pairs (i, j) of rows of ``a`` and ``b`` (of ``a`` alone, i < j, if ``b`` is None) with cosine >= threshold.

    With ``u = s p + e`` and ``v = t q + f``, ``|u.v - s t p.q| <= |s p| |f| + |e| |v|``.
    The integer products are exact in the chosen float type; only pairs that the
    bound leaves open are computed again in double precision.
    """
    alone = b is None
    a, b = _scaled(a), b if alone else _scaled(b)
    norm_a = np.linalg.norm(a, axis=1)
    p, s, len_a, err_a = quantised(a / norm_a[:, None])
    if alone:
        b, norm_b, q, t, err_b = a, norm_a, p, s, err_a
    else:
        norm_b = np.linalg.norm(b, axis=1)
        q, t, _, err_b = quantised(b / norm_b[:, None])
    exact = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    right = q.T.astype(exact)
    for lo in range(0, len(a), STRIP):
        hi = min(lo + STRIP, len(a))
        near = (p[lo:hi].astype(exact) @ right) * (s[lo:hi, None] * t[None, :])
        near += len_a[lo:hi, None] * err_b[None, :] + err_a[lo:hi, None] * (1 + 1e-12)
        i, j = np.nonzero(near >= threshold - 1e-9)
        i += lo
        if alone:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 1 << 16):
            x, y = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            true = np.einsum("ij,ij->i", a[x], b[y]) / (norm_a[x] * norm_b[y]) >= threshold
            yield x[true], y[true]


def _tile(threshold: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        low, high = key[2].as_py(), key[3].as_py()
        dim = key[1].as_py()
        names = table.column("c").to_numpy()
        sizes = table.column("size").to_numpy()
        slices = table.column("slice").to_numpy()
        vectors = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
        order = np.argsort(slices, kind="stable")
        names, sizes, slices, vectors = names[order], sizes[order], slices[order], vectors[order]
        forest, count = Forest(len(names)), np.zeros(len(names), np.int64)
        cut_ = int(np.searchsorted(slices, high)) if high != low else 0
        pairs = tile_links(vectors, None, threshold) if high == low else tile_links(vectors[:cut_], vectors[cut_:], threshold)
        for i, j in pairs if high == low or 0 < cut_ < len(names) else ():
            j = j + cut_
            forest.add(i, j)
            np.add.at(count, i, sizes[j])
            np.add.at(count, j, sizes[i])
        use = np.flatnonzero(count)
        return pa.table({"c": names[use], "links": count[use], "root": names[forest.root[use]]})

    return run


def near_vectors(
    rows: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    slice_size: int = SLICE,
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` of every row.

    Two rows link when their labels are equal and not null and their cosine in double
    precision reaches ``threshold``. Vectors that are null, empty, zero or hold a null
    or non-finite component link with nothing, and so do vectors of different lengths.
    Repeated vectors are folded into one with a count first, which makes ``n_links``
    exact without expanding copies; repeated ids are separate rows; a null id never
    names a class. An empty table gives no rows.

    The distinct vectors of a label are dealt into slices of about ``slice_size``
    and every pair of slices is one task's tile, so a hot label becomes many tiles.
    A tile returns, for each vector with links, a count and one link of a spanning
    forest, never its pairs.
    """
    vec = F.col(vec_col).cast("array<double>")
    sound = F.coalesce(
        F.col(label_col).isNotNull() & (F.size(vec) > 0)
        & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(vec, lambda x: x != 0),
        F.lit(False),
    )
    base = rows.select(F.col(id_col).cast("long").alias("i"), F.col(label_col).alias("label"), vec.alias("vec"), sound.alias("sound"))
    base = base.withColumns({"h": F.xxhash64("label", "vec"), "g": F.hash("vec", "label")})
    folded = base.filter("sound").groupBy("h", "g").agg(
        F.first("label").alias("label"), F.first("vec").alias("vec"), F.min("i").alias("least"), F.count("*").alias("size")
    )
    classes = cut(folded.withColumn("c", F.monotonically_increasing_id()))
    counts = classes.groupBy("label", F.size("vec").alias("dim")).count()
    slices = counts.select(F.col("label").alias("l"), F.col("dim"), F.ceil(F.col("count") / slice_size).cast("int").alias("n"))
    dealt = classes.join(slices, (F.col("label") == F.col("l")) & (F.size("vec") == F.col("dim")))
    dealt = dealt.withColumn("slice", F.pmod(F.xxhash64("c"), F.col("n")).cast("int"))
    tiles = dealt.select("label", "dim", "c", "size", "vec", "slice", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    tiles = tiles.withColumns({"low": F.least("slice", "other"), "high": F.greatest("slice", "other")})
    found = cut(tiles.groupBy("label", "dim", "low", "high").applyInArrow(_tile(threshold), "c long, links long, root long"))
    roots = components(found.filter("c <> root").select(F.col("c").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("c").agg(F.sum("links").alias("links")).withColumnRenamed("c", "k")
    named = classes.select("h", "g", "c", "least", "size").join(roots, F.col("c") == F.col("node"), "left").join(links, F.col("c") == F.col("k"), "left")
    copy = F.struct("h", "g")
    named = cut(named.select(copy.alias("copy"), "least", "size", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n"), F.coalesce("root", "c").alias("root")))
    least = named.groupBy("root").agg(F.min("least").alias("first"), F.count("*").alias("many"))
    named = join_classes(named, least, "root", "many", {"first": "component"})
    base = base.select("i", "sound", F.when(F.col("sound"), copy).alias("copy"))
    joined = join_classes(base, named.select("copy", "size", "n", "component"), "copy", "size", {"n": "n", "component": "component"})
    component = F.when(F.col("sound"), F.col("component")).otherwise(F.col("i"))
    return joined.select(
        F.col("i").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("i").eqNullSafe(component).alias("kept"),
    )
