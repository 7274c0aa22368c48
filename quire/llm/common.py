"""Shared plumbing of the corpus operators: shared-folder tables, Arrow mapping, bounded samples."""

from __future__ import annotations

import ctypes
import pickle
import re
import tempfile
import uuid
from collections.abc import Callable, Collection, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.workers import share_package

#: Bytes of one Arrow batch handed to a Python worker; bounds the worker's memory for texts of any length but a single giant one.
BATCH_BYTES = 2 << 20


def named(column: str) -> Column:
    """A column by its exact name, whatever characters are in it."""
    return F.col("`" + column.replace("`", "``") + "`")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Where the session names none, a private folder serves in local mode, which has one machine; elsewhere that is an error,
    as executors would write to disks that others cannot read.
    """
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = spark.conf.get("spark.quire.shared.dir", None)
    if own is None:
        own = "file://" + tempfile.mkdtemp(prefix="quire-shared-")
        spark.conf.set("spark.quire.shared.dir", own)
    return own


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write `df` as Parquet in the shared folder and read it back.

    Survives lost executors (unlike a local checkpoint), is columnar, and each call has its own path.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quire-{name}-{uuid.uuid4().hex}"
    schema = df.schema
    # small row groups and pages: writers and readers of wide rows stay within little memory
    df.write.option("parquet.block.size", 16 << 20).option("parquet.page.size", 256 << 10).parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._quire_path = path
    _tables.setdefault(spark.sparkContext.applicationId, []).append(path)
    return out


_tables: dict[str, list[str]] = {}


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(table: DataFrame) -> None:
    """Delete a materialised table that no later step reads."""
    _delete(table.sparkSession, table._quire_path)
    _tables[table.sparkSession.sparkContext.applicationId].remove(table._quire_path)


def discard_all(spark: SparkSession, but: Collection[str] = ()) -> None:
    """Delete every table this application has materialised, those at the paths `but` excepted; call it when the results have been written."""
    for path in _tables.pop(spark.sparkContext.applicationId, []):
        if path in but:
            _tables.setdefault(spark.sparkContext.applicationId, []).append(path)
        else:
            _delete(spark, path)


def tables(spark: SparkSession) -> list[str]:
    """The paths of the tables this application has materialised and not deleted yet."""
    return list(_tables.get(spark.sparkContext.applicationId, []))


def tune(spark: SparkSession) -> None:
    """Session settings the operators rely on; all are runtime settings and none changes a result."""
    share_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    # shuffle files of a finished action are not needed again: every reuse goes through materialize()
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def map_arrow(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], dict[str, pa.Array]]],
    fields: list[tuple[str, T.DataType]],
    keep: list[str],
    read: tuple[str, ...] = ("text",),
) -> DataFrame:
    """Run `make()` once per task and its result on every Arrow batch of the columns `read`; `keep` columns pass through unchanged.

    The function gets a batch and returns one array per entry of `fields`, row-aligned with the batch. Columns to keep
    may have any name; one that has the name of a result gives way to the result.
    """
    results = {n for n, _ in fields}
    keep = [c for c in dict.fromkeys(keep) if c not in results]
    inner = [f"__keep_{i}" for i in range(len(keep))]
    df = df.select(*[named(c).alias(k) for c, k in zip(keep, inner, strict=True)], *[named(c) for c in read])
    schema = T.StructType([T.StructField(k, df.schema[k].dataType, True) for k in inner] + [T.StructField(n, t, True) for n, t in fields])
    names = [n for n, _ in fields]
    target = {n: to_arrow(t) for n, t in fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            work = work or make()
            out = work(batch)
            cols = [batch.column(batch.schema.get_field_index(k)) for k in inner]
            cols += [out[n] if isinstance(out[n], pa.Array) else pa.array(out[n], type=target[n]) for n in names]
            yield pa.RecordBatch.from_arrays(cols, names=[*inner, *names])
            del batch, out, cols
        give_back()

    return df.mapInArrow(run, schema).select(*[F.col(k).alias(c) for c, k in zip(keep, inner, strict=True)], *names)


def give_back() -> None:
    """Return the memory that a finished task has freed to the system; workers live on between tasks, beside others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def to_arrow(t: T.DataType) -> pa.DataType:
    simple = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "float": pa.float32(), "boolean": pa.bool_(), "binary": pa.binary()}
    if isinstance(t, T.ArrayType):
        return pa.list_(to_arrow(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([(f.name, to_arrow(f.dataType)) for f in t.fields])
    return simple[t.simpleString()]


def held_out(column: str, folds: int, fold: int):
    """Whether crc32 of the id as text falls in the held-out fold; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit_in_task(rows: DataFrame, fit: Callable[[dict[str, list]], object]) -> object:
    """Fit a model on a bounded sample inside one task; only the (bounded) model comes to the driver.

    `rows` must be a limited DataFrame, so that it is one partition; `fit` gets its columns as lists.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: dict[str, list] = {}
        for batch in batches:
            for name, values in batch.to_pydict().items():
                columns.setdefault(name, []).extend(values)
        model = pickle.dumps(fit(columns))
        columns.clear()
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    found = rows.mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0].model) if found else fit({})


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, folds: int, fold: int, max_chars: int) -> DataFrame:
    """At most `per_class` training rows of each label value (0 and 1), outside the held-out fold.

    The ids are the first ones in the order of a hash, so the sample does not depend on partitioning. Texts over
    `max_chars` characters are left out of the training sample only. The result (text, y) is bounded by
    2 * per_class texts.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out("doc_id", folds, fold))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
    )
    picked = None
    for value in (0, 1):
        one = ids.where(F.col("y") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = one if picked is None else picked.unionByName(one)
    return (
        docs.select("doc_id", "text")
        .where(F.length("text") <= max_chars)
        .join(F.broadcast(picked), "doc_id")  # at most 2 * per_class ids
        .select("doc_id", "text", "y")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text")
        .limit(2 * per_class)
    )
