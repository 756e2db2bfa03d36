"""Tables as Parquet directories, large ones partitioned by month."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citytrips.operators.merge import FEW_KEYS, with_keys_of, without_keys_of
from citytrips.session import free_shuffles
from citytrips.sources import keyindex

MONTH = "pickup_month"
# Named here, as another session's default may leave the digests of keys uncompressed.
CODEC = "zstd"
CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"  # the default of the CSV writer cuts microseconds


def write_table(df: DataFrame, path: str, partition_by: str | None = None,
                order_by: Sequence[str] = (), dealt: bool = False, more: Sequence[DataFrame] = ()) -> None:
    """Replace a table: the new version is written beside it, then takes its place.

    A write that fails leaves the old table whole. Rows ``dealt`` by ``partition_by`` already
    are not shuffled again. Frames with ``more`` rows, all of other partitions, are written one by one.
    """
    fresh = f"{path}.{uuid.uuid4().hex}.new"
    remove(df.sparkSession, keyindex.folder(path))  # an index without some keys would be worse than none
    if partition_by:
        _write_months(df, fresh, partition_by, order_by, "static", dealt)
        for part in more:
            free_shuffles(df.sparkSession)
            _write_months(part, fresh, partition_by, order_by, "dynamic", dealt)
    else:
        df.write.parquet(fresh, compression=CODEC)
    _swap(df.sparkSession, fresh, path)


def _swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a written folder in the place of another one by two renames."""
    files = _file_system(spark, path)
    target, old = _hadoop_path(spark, path), _hadoop_path(spark, f"{fresh}.old")
    files.mkdirs(target.getParent())
    replaced = files.exists(target)
    if replaced and not files.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(_hadoop_path(spark, fresh), target):
        if replaced:
            files.rename(old, target)
        raise OSError(f"cannot put {fresh} in the place of {path}")
    if replaced:
        files.delete(old, True)
    spark.catalog.refreshByPath(path)


def _write_months(df: DataFrame, path: str, column: str, order_by: Sequence[str],
                  scope: str, dealt: bool = False) -> None:
    # A rebalance lets adaptive execution merge small months and split a month that holds much
    # of the data over several tasks; a plain ``repartition(column)`` would leave it to one.
    if not dealt:
        df = df.hint("rebalance", F.col(column))
    if order_by:
        df = df.sortWithinPartitions(column, *order_by)
    (df.write.mode("overwrite").option("partitionOverwriteMode", scope)
       .partitionBy(column).parquet(path, compression=CODEC))


def overwrite_months(df: DataFrame, path: str, order_by: Sequence[str] = (), dealt: bool = False) -> None:
    """Replace only the months that occur in df; it may read the same table."""
    _write_months(df, path, MONTH, order_by, "dynamic", dealt)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               evolving: bool = False) -> DataFrame | None:
    """A table, or None where it does not exist yet.

    A declared schema avoids reading footers and brings older files to the present columns;
    ``evolving`` merges the schemas of all files instead.
    """
    try:
        reader = spark.read
        if schema is not None:
            # Also probes the path, which a reader with a schema does lazily.
            reader = reader.schema(schema)
        elif evolving:
            reader = reader.option("mergeSchema", "true")
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def months_present(spark: SparkSession, path: str) -> set:
    """Months of a table by the names of its folders; no file is opened."""
    if not exists(spark, path):
        return set()
    prefix, out = f"{MONTH}=", set()
    for status in _file_system(spark, path).listStatus(_hadoop_path(spark, path)):
        name = status.getPath().getName()
        if name.startswith(prefix):
            value = name.removeprefix(prefix)
            out.add(int(value) if value.isdigit() else None)
    return out


def months_of(df: DataFrame) -> set:
    """Distinct months; one small value per calendar month reaches the driver."""
    return {row[0] for row in df.select(MONTH).distinct().collect()}


def _read_months(spark: SparkSession, path: str, months: set) -> DataFrame | None:
    """The given months of a table with all columns any of them has.

    Only footers of these months are read, however many the table holds.
    """
    folders = [_folder(path, m) for m in sorted(months, key=str)]
    present = [f for f in folders if exists(spark, f)]
    if not present:
        return None
    reader = spark.read.option("basePath", path).option("mergeSchema", "true")
    return reader.parquet(*present)


def merge_into(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
               movable: tuple[str, ...] | None = None, order_by: Sequence[str] = (),
               dealt: bool = False, ordered: DataFrame | None = None) -> None:
    """Upsert a landed batch, which carries ``pickup_month``, into a table of months.

    Keys are unique within the batch. Only the months the batch touches are read and written
    again. Where a key does not contain the time, an older version of a row may lie in
    another month: ``movable`` is ``()`` when that can be any row, or ``(column, value)`` for
    rows with that value. The key index names their months, which are rewritten too; other months
    are not read at all. Rows of a batch ``dealt`` by month are not shuffled again, and rows of the
    table only where many of them stay beside a large batch. ``ordered`` has the batch once more in
    the order it is written in, and is read only where it is written alone.
    """
    alone = batch if ordered is None else ordered
    if not exists(spark, path):
        write_table(alone, path, MONTH, order_by, dealt)
        return
    months, moved_from = months_of(batch), set()
    if movable is not None:
        ensure_index(spark, path, keys, movable)
        moved_from = keyindex.months_and_note(spark, path, _movable_rows(batch, movable), keys) - months
    target = _read_months(spark, path, months | moved_from)
    if target is None:
        overwrite_months(alone, path, order_by, dealt)
        return
    few, kept = batch.count() <= FEW_KEYS, None
    if not few:
        # The keys alone tell how many rows stay.
        staying = without_keys_of(target.select(*keys), batch, keys)
        found = staying.limit(FEW_KEYS + 1).count()
        if found == 0:
            overwrite_months(alone, path, order_by, dealt)
            _remove_months(spark, path, moved_from)
            return
        if found <= FEW_KEYS:
            kept = with_keys_of(target, staying, keys)
    if kept is None:
        kept = without_keys_of(target, batch, keys, few)
    # A month that loses all its rows is not part of the result, so the write leaves it alone.
    emptied = moved_from - months_of(kept) if moved_from else set()
    if dealt:
        kept = kept.hint("rebalance", F.col(MONTH))
    overwrite_months(kept.unionByName(batch, allowMissingColumns=True), path, order_by, dealt)
    _remove_months(spark, path, emptied)


def _remove_months(spark: SparkSession, path: str, months: set) -> None:
    for month in months:
        _file_system(spark, path).delete(_hadoop_path(spark, _folder(path, month)), True)


def _movable_rows(df: DataFrame, movable: tuple[str, ...]) -> DataFrame:
    return df.filter(F.col(movable[0]) == movable[1]) if movable else df


def ensure_index(spark: SparkSession, path: str, keys: Sequence[str],
                 movable: tuple[str, ...] = ()) -> None:
    """Build the key index of a table from its key columns unless it is there."""
    if exists(spark, f"{keyindex.folder(path)}/filters/_SUCCESS"):
        return
    known = read_table(spark, path)
    keyindex.build(spark, path, _movable_rows(known, movable), keys)


def _folder(path: str, month) -> str:
    return f"{path}/{MONTH}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}"


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system it lies in."""
    return _file_system(spark, path).makeQualified(_hadoop_path(spark, path)).toString()


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_hadoop_path(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the store."""
    _file_system(spark, path).delete(_hadoop_path(spark, path), True)


def materialize(df: DataFrame, mode: str, name: str, path: str | None = None) -> DataFrame:
    """Materialise as ``view``, ``table`` or ``ephemeral`` (inlined); returns the relation.

    The fourth mode, ``incremental``, is ``plans.pipeline.refresh``.
    """
    spark = df.sparkSession
    if mode == "ephemeral":
        return df
    if mode == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if mode == "table":
        if path is None:
            raise ValueError("a table needs a path")
        write_table(df, path)
        return spark.read.parquet(path)
    raise ValueError(f"unknown mode: {mode}")


def stage(df: DataFrame, path: str) -> DataFrame:
    """Land a frame as Parquet in a staging zone and read it back."""
    df.write.mode("overwrite").parquet(path, compression=CODEC)
    return df.sparkSession.read.parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Write a result as CSV with a header."""
    (df.write.mode("overwrite").option("header", "true").option("timestampNTZFormat", CSV_TIME)
       .csv(path))
