"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and every executor can reach.

    It is the session's ``spark.checkpoint.dir``. Where that is unset, a
    temporary folder takes its place if all tasks run on this machine, as in
    tests; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if _local not in _folders:
        _folders[_local] = "file://" + tempfile.mkdtemp(prefix="lattica-")
    return _folders[_local]


_local = "local"
_folders: dict[str, str] = {}


def discard(spark: SparkSession, path: str) -> None:
    """Removes a file or folder, if it is there."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _discard_at_exit(spark: SparkSession, path: str) -> None:
    try:
        discard(spark, path)
    except Exception:  # the session may have ended before
        return


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    Cuts the lineage: what follows survives the loss of any executor without
    repeating what led to ``df``, and several readers share one computation.
    The table is removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lattica/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_discard_at_exit, spark, path)
    return spark.read.schema(df.schema).parquet(path)


#: A key is hot if it has more than one in HOT of all rows, and more than PER_KEY; so there are fewer than HOT hot keys.
HOT, PER_KEY = 256, 10_000


def join_by_hot(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` with what ``right``, a written table that has each key once, holds for ``key``, null if nothing.

    Rows of ``left`` with a hot key are joined by broadcast, where they lie;
    so no task gathers them.
    """
    counts = left.groupBy(key).agg(F.count("*").alias("_n"))
    total = left.count()
    hot = written(counts.where(F.col(key).isNotNull() & (F.col("_n") > max(PER_KEY, total // HOT))).select(key, F.lit(True).alias("_hot")), f"hot-{key}")
    if not hot.limit(1).count():
        return left.join(right, key, "left")
    marked = left.join(F.broadcast(hot), key, "left")  # fewer than HOT rows
    small = F.broadcast(right.join(F.broadcast(hot.select(key)), key, "left_semi"))
    return marked.where("_hot").drop("_hot").join(small, key, "left").unionByName(marked.where("_hot is null").drop("_hot").join(right, key, "left"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def hash_unit(*columns: Column) -> Column:
    """A number in [0, 1) that the text of ``columns`` decides."""
    return F.conv(F.substring(F.md5(F.concat_ws("\x01", *columns)), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def hash_bucket(column: Column, n: int) -> Column:
    """A number from 0 to ``n`` - 1 that ``column`` decides; null counts as an empty text."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")
