"""Spark plumbing shared by the operators: cutting lineage, stored tables and fixed-size filters."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of the filters that scans carry: 1 MB whatever the size of the data. A full filter only lets more rows through.
FILTER_BITS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, else (single-machine sessions) a temporary one."""
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="kinweave-")
    sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read from a checkpoint in the shared folder."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written as a table in the shared folder and read back.

    With the default codec: zstd keeps native buffers for each column of each file, outside what the heap bounds.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kinweave-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps: it does so, beside other work, once the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.3)


#: Rows of an Arrow batch, where the session has Spark's default: texts are long, and a batch is held several times over.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def trim() -> None:
    """Gives memory that a worker process no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow for a function of one batch."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)
        del batches
        trim()

    return df.mapInArrow(run, schema)


def slot(*keys: str | Column) -> Column:
    """A row's place in a filter of FILTER_BITS bits."""
    return F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS)).cast("int")


def filter_of(df: DataFrame, place: Column) -> np.ndarray:
    """A bitmap of the places that occur. At most FILTER_BITS / 64 numbers reach the driver."""
    words = (
        df.select(place.alias("p"))
        .groupBy(F.shiftright("p", 6).alias("w"))
        .agg(F.expr("bit_or(shiftleft(1L, p & 63))").alias("b"))
        .toArrow()
    )
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out


def passes(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which places the filter lets through."""
    return (bitmap[places >> 6] >> (places & 63).astype(np.int64)) & 1 == 1


def quoted(column: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs``, whatever their columns, whose doc_id is not in ``dropped`` (doc_id).

    A fixed-size filter keeps most texts out of the shuffle. Rows travel as one struct, so no column's name can clash.
    """
    bitmap, columns = filter_of(dropped, slot("doc_id")), docs.columns
    packed = docs.select(F.struct(*map(quoted, columns)).alias("row"), F.col("doc_id").cast("long").alias("id"))
    packed = packed.withColumn("place", slot("id"))

    def part(inside: bool) -> DataFrame:
        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ok = passes(bitmap, batch["place"].to_numpy())
            yield batch.filter(pa.array(ok if inside else ~ok))

        return map_arrow(packed, run, packed.schema)

    gone = dropped.select(F.col("doc_id").cast("long").alias("id")).distinct()
    rows = part(False).unionByName(part(True).join(gone, "id", "left_anti"))
    return rows.select(*(F.col("row")[c].alias(c) for c in columns))


def repeated(rows: DataFrame, name: str, flag: str, most_hot: int = 1000) -> DataFrame:
    """``rows``, a stored table, with a column ``flag``: whether their ``name`` (long) occurs in more than one row.

    Names are counted in every task before the shuffle. A name in more than one of ``most_hot`` rows is hot; there are
    fewer than ``most_hot`` of these, so they are broadcast, and no task gets all rows of one name.
    """
    counts = stored(rows.groupBy(name).agg(F.count("*").alias("count_")).where("count_ > 1"))
    total = rows.count()
    hot = counts.where(F.col("count_") * most_hot > total).select(name, F.lit(True).alias("hot_"))
    marked = rows.join(F.broadcast(hot), name, "left")
    rest = marked.where("hot_ is null").drop("hot_").join(counts.select(name, F.lit(True).alias(flag)), name, "left")
    rest = rest.withColumn(flag, F.coalesce(flag, F.lit(False)))
    return marked.where("hot_").drop("hot_").withColumn(flag, F.lit(True)).unionByName(rest)


def drop_stored(df: DataFrame) -> None:
    """Deletes a stored table that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/kinweave-tables/" in folder:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
