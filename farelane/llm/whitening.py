"""Embedding whitening: centred rows as a distributed block matrix, its scatter, and the projected rows."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from farelane.llm.shared import cut, partitions
from farelane.staging import stage

#: Bytes of a block of doubles, at most; a task holds a few blocks.
BLOCK_BYTES = 4 << 20
#: Columns of a block.
BLOCK_COLUMNS = 1024
#: Blocks of a slab. Multiplying block matrices names every block on the driver, so a larger table is multiplied slab by slab.
SLAB = 1 << 16
#: Products are moved to this bound, far above any embedding, so that sums over millions of such entries fit a long.
MOST = float(1 << 43)

_AT = StructType([StructField("_1", LongType()), StructField("_2", LongType())])
_BLOCKS = StructType(
    [StructField("at", _AT), StructField("block", MatrixUDT()), StructField("row", ArrayType(IntegerType())),
     StructField("i", ArrayType(LongType())), StructField("deviation", ArrayType(LongType()))]
)


def fixed_point(vec: Column, scale: float, offset: int) -> Column:
    """Every entry c as the long ``floor(scale * c) + offset``, within :data:`MOST`."""
    bound = lambda c: F.greatest(F.least(c * F.lit(float(scale)), F.lit(MOST)), F.lit(-MOST))
    return F.transform(vec, lambda c: F.floor(bound(c)).cast("long") + F.lit(offset).cast("long"))


def _exact(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums``; as Python integers where 64 bits might not hold it."""
    most = n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, sums.tolist()), default=0)
    return x * n - sums if most < 1 << 63 else x.astype(object) * n - sums.astype(object)


def _deviations(t: np.ndarray) -> list[int | None]:
    """The sum of squares of every row, null beyond 63 bits."""
    if t.dtype != object and t.size and int(np.abs(t).max()) ** 2 * t.shape[1] < 1 << 63:
        return np.einsum("ij,ij->i", t, t).tolist()
    totals = (sum(int(v) * int(v) for v in row) for row in t)
    return [v if v < 1 << 63 else None for v in totals]


def _dense(m: np.ndarray) -> dict:
    """A matrix of MLlib in the form Arrow carries, row after row."""
    return {
        "type": 1, "numRows": m.shape[0], "numCols": m.shape[1], "colPtrs": None, "rowIndices": None,
        "values": np.ascontiguousarray(m, np.float64).ravel(), "isTransposed": True,
    }


def _array(matrix: pa.StructScalar) -> np.ndarray:
    shape = matrix["numRows"].as_py(), matrix["numCols"].as_py()
    values = matrix["values"].values.to_numpy(zero_copy_only=False)
    return values.reshape(shape) if matrix["isTransposed"].as_py() else values.reshape(shape[::-1]).T


def _partial_sums(dim: int):
    """For every partition of the written table that a task reads: rows of ``dim`` entries, the last place, sums."""

    def run(source):
        found: dict[int, list] = {}
        for batch in source:
            part = batch.column(0).to_numpy() >> 33
            place = batch.column(0).to_numpy() & ((1 << 33) - 1)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            for p in np.unique(part).tolist():
                mine = part == p
                held = found.setdefault(p, [0, 0, np.zeros(dim, np.int64)])
                held[0] += int(mine.sum())
                held[1] = max(held[1], int(place[mine].max()) + 1)
                held[2] += x[mine].sum(axis=0)
        if found:
            n, size, sums = zip(*found.values())
            yield pa.record_batch(
                [pa.array(list(found)), pa.array(n), pa.array(size), pa.array([s.tolist() for s in sums], pa.list_(pa.int64()))],
                names=["part", "n", "size", "sums"],
            )

    return run


def _make_blocks(n: int, sums: np.ndarray, rows: int, columns: int):
    """Rows of one block, centred, as matrices of at most ``columns`` columns; ids go with the first."""
    kind, at_kind = to_arrow_type(MatrixUDT()), to_arrow_type(_AT)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        block, dim = key[0].as_py(), len(sums)
        place = table.column("row").to_numpy()
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        exact = _exact(x, n, sums)
        centred = np.zeros((rows, dim))
        centred[place] = (exact / n).astype(np.float64)
        out = {name: [] for name in _BLOCKS.names}
        for j, c in enumerate(range(0, dim, columns)):
            out["at"].append({"_1": block, "_2": j})
            out["block"].append(_dense(centred[:, c : c + columns]))
            out["row"].append(None if j else place)
            out["i"].append(None if j else table.column("i").to_pylist())
            out["deviation"].append(None if j else _deviations(exact))
        kinds = [at_kind, kind, pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.table({name: pa.array(out[name], t) for name, t in zip(_BLOCKS.names, kinds)})

    return run


def _matrix(blocks: DataFrame, per_row: int, per_column: int, shape: tuple[int, int]) -> BlockMatrix:
    """A block matrix of ``(at, block)`` rows, made in the JVM."""
    made = callMLlibFunc("createBlockMatrix", blocks.select("at", "block"), per_row, per_column, *shape)
    return BlockMatrix(made, per_row, per_column)


def _product(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """``a b``, the sum over the inner blocks dealt into ``splits`` tasks for each block of the result."""
    made = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, a.rowsPerBlock, b.colsPerBlock)


def _scatter(m: BlockMatrix, splits: int) -> np.ndarray:
    return _product(m.transpose(), m, splits).toLocalMatrix().toArray()


def _rows_out(kept: int, count: int, n: int, explained: list[float | None], error: float | None):
    """Component rows of one block: ids and deviations of its rows beside their projections."""

    def run(ids: pa.Table, projected: pa.Table) -> pa.Table:
        ids = ids.filter(ids.column("i").is_valid())
        out = {"i": [], "component": [], "deviation": [], "whitened": []}
        for k in range(ids.num_rows):
            i, deviation = ids.column("i")[k].values, ids.column("deviation")[k].values
            whitened = np.full((len(i), count), np.nan)
            if kept:
                whitened[:, :kept] = _array(projected.column("block")[0])[ids.column("row")[k].values.to_numpy()]
            many = np.repeat(np.arange(len(i)), count)
            out["i"].append(i.take(pa.array(many)))
            out["deviation"].append(deviation.take(pa.array(many)))
            out["component"].append(pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(i))))
            flat = whitened.ravel()
            out["whitened"].append(pa.array(flat, pa.float64(), mask=np.isnan(flat)))
        kinds = {"i": pa.int64(), "component": pa.int32(), "deviation": pa.int64(), "whitened": pa.float64()}
        table = pa.table({name: pa.chunked_array(v, kinds[name]) for name, v in out.items()})
        m = table.num_rows
        share = pa.array(np.tile(np.array([np.nan if e is None else e for e in explained]), m // max(count, 1)), from_pandas=True)
        table = table.append_column("explained", share.cast(pa.float64()))
        table = table.append_column("n", pa.array(np.full(m, n, np.int64)))
        return table.append_column("identity_error", pa.array([error] * m, pa.float64()))

    return run


def components(scatter: np.ndarray, n: int, count: int) -> tuple[np.ndarray, list[float | None], int]:
    """(whitening matrix of the components with variance, share of each of ``count`` components, how many have variance).

    Eigenvalues that rounding alone can make count as none. The entry of largest
    magnitude of every eigenvector is positive.
    """
    covariance = (scatter + scatter.T) / (2.0 * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    trace = float(np.trace(covariance))
    kept = int((values > len(covariance) * np.finfo(float).eps * max(trace, 0.0)).sum())
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    share = [max(float(v), 0.0) / trace if trace > 0 else None for v in values]
    return vectors[:, :kept] / np.sqrt(values[:kept]), share, kept


def whiten(
    rows: DataFrame, count: int = 32, scale: float = 64, offset: int = 1_000_000, id_col: str = "vec_id", vec_col: str = "embedding",
    block_bytes: int = BLOCK_BYTES, columns: int = BLOCK_COLUMNS, slab: int = SLAB,
) -> DataFrame:
    """``(id_col, component, n, deviation, whitened, explained, identity_error)`` for every sound row and component.

    Entries become the longs ``x = floor(scale * c) + offset``. With the sums S over
    all n sound rows, ``deviation`` is the exact sum of ``(n x - S)^2`` (null beyond 63
    bits), ``whitened`` the projection of ``x - S / n`` on a unit eigenvector of the
    covariance (divisor n) over the root of its eigenvalue, ``explained`` the
    eigenvalue's share of the trace and ``identity_error`` the largest entry of the
    covariance of the whitened rows minus the identity. Components are numbered from 1
    by falling eigenvalue, ``count`` at most.

    Rows whose vector is null, empty or holds a null or non-finite entry have no
    result. All vectors have one length; of a mixture the commonest length (the
    largest of several) is whitened, and other rows have no result. Components without
    variance have a null ``whitened`` and don't count in ``identity_error``. Repeated
    rows and ids, and null ids, are rows like any other; no sound row gives no rows.

    Rows get dense indexes from one number per partition and meet in blocks of at most
    ``block_bytes``; MLlib multiplies the block matrix by its transpose in as many tasks
    as there are partitions, and by the whitening matrix. The driver holds two square
    matrices, and the places of the blocks of one slab.
    """
    spark = rows.sparkSession
    schema = f"{id_col} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    vec = F.col(vec_col).cast("array<double>")
    sound = (F.size(vec) > 0) & F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    base = rows.select(F.col(id_col).cast("long").alias("i"), vec.alias("v")).filter(F.coalesce(sound, F.lit(False)))
    written = stage(base.select(F.monotonically_increasing_id().alias("m"), "i", fixed_point(F.col("v"), scale, offset).alias("x")), "whitening")
    common = written.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    dim, n = common["dim"], common["count"]
    count = min(count, dim)
    written = written.filter(F.size("x") == dim)
    partial = cut(written.select("m", "x").mapInArrow(_partial_sums(dim), "part long, n long, size long, sums array<long>"))
    by_place = partial.select(F.posexplode("sums").alias("k", "s")).groupBy("k").agg(F.sum("s").alias("s"))
    sums = np.array([r["s"] for r in by_place.orderBy("k").collect()], np.int64)
    sizes = partial.groupBy("part").agg(F.max("size").alias("size")).orderBy("part").collect()
    total = sum(r["size"] for r in sizes)
    per_row = max(1, min(block_bytes // (8 * min(dim, columns)), -(-total // (4 * partitions(spark)))))

    indexed = written.join(F.broadcast(_offsets(spark, sizes)), F.shiftright("m", 33) == F.col("part"))
    index = F.col("before") + F.col("m").bitwiseAND((1 << 33) - 1)
    placed = indexed.select("i", "x", F.floor(index / per_row).alias("block"), F.pmod(index, F.lit(per_row)).cast("int").alias("row"))
    blocks = cut(placed.groupBy("block").applyInArrow(_make_blocks(n, sums, per_row, columns), _BLOCKS))

    number = -(-total // per_row)
    slabs = []
    for low in range(0, number, slab):
        here = blocks.filter(F.col("at._1").between(low, low + slab - 1)) if number > slab else blocks
        here = here.withColumn("at", F.struct((F.col("at._1") - low).alias("_1"), F.col("at._2").alias("_2")))
        size = min(slab, number - low)
        slabs.append((here, size, max(1, min(size, partitions(spark)))))
    scatter = reduce(np.add, (_scatter(_matrix(b, per_row, columns, (size * per_row, dim)), k) for b, size, k in slabs))
    whitening, explained, kept = components(scatter, n, count)

    projected, square = [], np.zeros((kept, kept))
    for b, size, k in slabs:
        if not kept:
            projected.append(b.select("at", "block").limit(0))
            continue
        made = _project(spark, _matrix(b, per_row, columns, (size * per_row, dim)), whitening, columns)
        projected.append(made)
        square += _scatter(_matrix(made, per_row, kept, (size * per_row, kept)), k)
    error = float(np.abs(square / n - np.eye(kept)).max()) if kept else None

    run = _rows_out(kept, count, n, explained, error)
    out_schema = "i long, component int, deviation long, whitened double, explained double, n long, identity_error double"
    outs = []
    for (b, _, _), p in zip(slabs, projected):
        ids = b.filter("at._2 = 0").select(F.col("at._1").alias("b"), "row", "i", "deviation")
        seen = p.select(F.col("at._1").alias("b"), "block")
        outs.append(ids.groupBy("b").cogroup(seen.groupBy("b")).applyInArrow(run, out_schema))
    out = reduce(DataFrame.unionByName, outs)
    return out.select(F.col("i").alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error")


def _offsets(spark: SparkSession, sizes: list) -> DataFrame:
    """``(part, before)``: how many places stand before each partition, one row per partition."""
    total, rows = 0, []
    for r in sizes:
        rows.append((r["part"], total))
        total += r["size"]
    return spark.createDataFrame(rows, "part long, before long")


def _project(spark: SparkSession, m: BlockMatrix, whitening: np.ndarray, columns: int) -> DataFrame:
    """``(at, block)`` of the rows of ``m`` times the whitening matrix, kept in the shared folder."""
    dim, kept = whitening.shape
    pieces = [whitening[c : c + columns] for c in range(0, dim, columns)]
    local = [((j, 0), DenseMatrix(len(w), kept, w.ravel(order="F").tolist())) for j, w in enumerate(pieces)]
    small = spark.createDataFrame(local, StructType([StructField("at", _AT), StructField("block", MatrixUDT())]))
    made = _product(m, _matrix(small, columns, kept, (dim, kept)), 1)
    found = callMLlibFunc("getMatrixBlocks", made._java_matrix_wrapper._java_model)
    at = F.struct(F.col("_1._1").cast("long").alias("_1"), F.col("_1._2").cast("long").alias("_2"))
    return cut(found.select(at.alias("at"), F.col("_2").alias("block")))
