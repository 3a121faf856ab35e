"""Tables written to the shared folder to cut lineage or feed a later step.

The folder is the one the cluster names in ``spark.checkpoint.dir``; where it names
none, a folder below the warehouse, which all executors share as well.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared")
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/farelane/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`new_folder` on whatever file system holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has finished: Spark leaves a mark there when all its files are in place."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def _on(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def create_new(spark: SparkSession, path: str, text: str = "") -> bool:
    """Put a small file in place with its whole content, unless there is one already; says whether it did.

    Of several writers exactly one succeeds: on local and mounted folders by a hard
    link, elsewhere by a rename, which must refuse an existing target, as HDFS does.
    """
    target, fs = _on(spark, path)
    fs.mkdirs(target.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() != "file":
            return not fs.exists(target) and fs.rename(draft, target)
        try:
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        except FileExistsError:
            return False
        return True
    finally:
        fs.delete(draft, False)


def read_small(spark: SparkSession, path: str) -> str:
    """The content of a file made by :func:`create_new`."""
    target, fs = _on(spark, path)
    source = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none if there is no such folder. Hidden drafts are left out."""
    target, fs = _on(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    return sorted(n for n in found if not n.startswith("."))


#: Copies that :func:`stage` has left in this session.
_COPIES: list[str] = []


def remove_copies(spark: SparkSession) -> None:
    """Delete the copies that :func:`stage` has made so far; their tables can't be read any more."""
    while _COPIES:
        remove_folder(spark, _COPIES.pop())


def _write(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Rebalanced on the folder columns, so that tasks don't scatter small files over all folders."""
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.partitionBy(*partition_by).parquet(path)


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy stays for as long as the result may be read; :func:`remove_copies` deletes it.
    """
    path = new_folder(df.sparkSession, label)
    _write(df, path, partition_by)
    _COPIES.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


@contextmanager
def staged(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """Like :func:`stage`, for jobs that finish inside the block; the copy is removed after it."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    try:
        _write(df, path, partition_by)
        yield spark.read.schema(df.schema).parquet(path).select(df.columns)
    finally:
        remove_folder(spark, path)
