"""Gold writers, exports and serving records."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


STAGE, READY = "_replace-", "_ready"


def _files(spark: SparkSession, path: str):
    """Hadoop's path class, and the file system that holds ``path``."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make, make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _partitions(fs, root) -> list[str]:
    """Names of the partition folders with files below ``root``, relative to it."""
    found, level = [], [(root, "")]
    while level:
        folder, name = level.pop()
        inside = fs.listStatus(folder)
        inner = [s.getPath() for s in inside if s.isDirectory() and "=" in s.getPath().getName()]
        level += [(p, f"{name}/{p.getName()}".lstrip("/")) for p in inner]
        # A folder that has been emptied is no partition.
        if name and any(s.isFile() for s in inside):
            found.append(name)
    return sorted(found)


def stage_gold(df: DataFrame, path: str, partitions: list[str], order: list[str] | None = None, as_read: bool = False) -> str:
    """Write what is to replace partitions of the table at ``path``; returns the folder of the new rows.

    It lies in the table's folder, where Spark's readers pass it over: the table changes with ``switch_gold``.
    The rebalance hint sizes the files at runtime and splits a partition value that holds much of
    the table, where a plain repartition by these columns would give it to one task. With ``order``
    the files are ranges of that order instead, each sorted. ``as_read`` is for rows that lie together by partition already,
    as those of scanned files do by file: they are written by the tasks that read them, without a shuffle.
    """
    finish_replacement(df.sparkSession, path)
    if as_read:
        laid_out = df
    elif order:
        laid_out = df.repartitionByRange(*partitions, *order).sortWithinPartitions(*partitions, *order)
    else:
        laid_out = df.hint("rebalance", *partitions)
    staged = f"{path.rstrip('/')}/{STAGE}{uuid.uuid4().hex}/rows"
    laid_out.write.partitionBy(*partitions).parquet(staged)
    return staged


def switch_gold(spark: SparkSession, path: str, staged: str, clear: DataFrame | None = None) -> None:
    """Put staged rows in the place of the partitions they belong to.

    ``clear`` holds values of the partition columns, in their order; such partitions go where nothing staged replaces them.
    The replacement is decided by one rename of a marker, which names what is to go. Then partition by
    partition moves; what a stop leaves undone, ``finish_replacement`` does. An old partition is removed
    only after its whole successor is on disk and the marker is set.
    """
    make, fs = _files(spark, path)
    folder = staged.removesuffix("/rows")
    new = set(_partitions(fs, make(staged)))
    old = []
    if clear is not None:
        named = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        values = clear.select(*[F.col(c).cast("string").alias(c) for c in clear.columns]).distinct()
        for row in values.toLocalIterator():  # one per partition
            name = "/".join(named(c, row[c]) for c in clear.columns)
            if name not in new:
                old.append(name)
    out = fs.create(make(f"{folder}/_writing"), True)
    out.write("\n".join(old).encode())
    out.close()
    if not fs.rename(make(f"{folder}/_writing"), make(f"{folder}/{READY}")):
        raise OSError(f"cannot mark {folder}")
    finish_replacement(spark, path)


def finish_replacement(spark: SparkSession, path: str) -> None:
    """Complete a replacement that was decided; remove what was staged without being decided.

    A table has one writer at a time, and it alone calls this: ``stage_gold``, and so every write, begins with it.
    """
    make, fs = _files(spark, path)
    root = make(path)
    if not fs.exists(root):
        return
    for folder in [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(STAGE)]:
        marker, rows = make(folder, READY), make(folder, "rows")
        if fs.exists(marker):
            stream = fs.open(marker)
            for name in bytes(stream.readAllBytes()).decode().split("\n"):
                if name:
                    fs.delete(make(root, name), True)
            stream.close()
            for name in _partitions(fs, rows):
                _move(make, fs, make(rows, name), make(root, name))
        fs.delete(folder, True)


def _move(make, fs, new, place) -> None:
    """``new`` in the place of the folder that may be there."""
    if fs.exists(place):
        fs.delete(place, True)
    fs.mkdirs(place.getParent())
    if not fs.rename(new, place):
        raise OSError(f"cannot move {new}")


def write_gold(
    df: DataFrame, path: str, partitions: list[str], order: list[str] | None = None, clear: DataFrame | None = None
) -> None:
    """Parquet partitioned by ``partitions``; the partitions present in ``df`` are replaced, those named by ``clear`` (see ``switch_gold``)
    at least removed.

    A stop at any point loses nothing: the table has the old partitions, or the new ones as soon as the writer's next
    write or ``table_or_empty`` has finished what was begun.
    """
    switch_gold(df.sparkSession, path, stage_gold(df, path, partitions, order), clear)


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType, own: bool = False) -> DataFrame:
    """The parquet table at ``path``; before its first write, an empty one.

    With ``own`` the caller is the table's one writer, and a replacement that a stop has left undone is finished first.
    Other readers must not do that beside the writer.
    """
    if own:
        finish_replacement(spark, path)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def export_sheets(df: DataFrame, path: str, sheet: str = "enr_aggregation_type") -> None:
    """Headed CSV for people, one directory per sheet value."""
    df.hint("rebalance", sheet).write.mode("overwrite").partitionBy(sheet).option("header", True).csv(path)


def serving_json(
    df: DataFrame, table: str, run: dict[str, str], keys: list[str], agg: str | None = None
) -> DataFrame:
    """One (cache_key, payload) per row: the record with where it comes from, its date and trace id.

    The key includes the aggregation type, so consolidated and individual records do not replace
    each other. Dates are ISO text.
    """
    suffix = F.concat(F.lit("_"), F.col(agg), F.lit("_")) if agg else F.lit("")
    key_parts = [F.lit(table), *([F.col(agg)] if agg else []), *[F.col(k).cast("string") for k in keys]]
    return df.select(
        F.concat_ws(":", *key_parts).alias("cache_key"),
        F.to_json(
            F.struct(
                F.struct(*[F.col(c) for c in df.columns]).alias("data"),
                F.concat(F.lit(f"gold/serving/{table}"), suffix, F.lit(".parquet")).alias("file_bucket_path"),
                F.lit(run["ref_date"]).alias("ref_date"),
                F.lit(run["trace_id"]).alias("trace_id"),
            ),
            {"dateFormat": "yyyy-MM-dd"},
        ).alias("payload"),
    )
