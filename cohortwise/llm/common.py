"""Small helpers that several corpus operators share."""

from __future__ import annotations

import sys
import tempfile
import uuid

import numpy as np
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Helpers travel inside the serialised tasks, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Shuffle files of a query that is checkpointed are of no use once it has run.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session without the setting, as in tests, gets a folder chosen here.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="llm-checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """Compute a reduced table once, in the shared folder, and cut its lineage.

    A lost executor loses nothing.
    """
    spark = df.sparkSession
    shared_folder(spark)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        # A new plan over the same query, so that the option above holds for it.
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(CLEANUP, before)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def own_columns(docs: DataFrame) -> list[Column]:
    """The columns of a table by name, dots and other signs included."""
    return [F.col(quoted(c)) for c in docs.columns]


def unused(docs: DataFrame, stem: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in docs.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def of_files(docs: DataFrame) -> bool:
    try:
        docs.metadataColumn("_metadata")
    except AnalysisException:
        return False
    return True


def addressed(docs: DataFrame) -> DataFrame:
    """A table whose rows :func:`place` can name: one of files as it is, others computed once."""
    return docs if of_files(docs) else kept(docs)


def place(docs: DataFrame) -> Column:
    """A number for each row of an :func:`addressed` table, the same on retries.

    Rows of files are named by file and position, however the input is split. A table computed
    once lies in the shared folder in fixed parts, and its rows are numbered by part.
    """
    if not of_files(docs):
        return F.monotonically_increasing_id()
    row = docs.metadataColumn("_metadata")
    return F.xxhash64(row["file_path"], row["row_index"])


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """A table written to the shared folder as Parquet and read again, and its path."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete what :func:`stored` wrote."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: str) -> Column:
    """crc32 of the id as text modulo 3; fold 1 is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3, F.lit(0))


def bit_map(keys: DataFrame, column: str, bits: int) -> bytes:
    """A map of ``2 ** bits`` bits with those set that the 64-bit numbers in a column fall on.

    Its size is fixed, so it may go to every task: a clear bit rules a key out, a set one does
    not prove it. Spark sets the bits; at most ``2 ** bits / 64`` words reach the driver.
    """
    spot = F.pmod(F.col(column), F.lit(2**bits))
    words = keys.where(F.col(column).isNotNull()).select(
        F.shiftright(spot, 6).alias("word"), F.expr("1L").alias("one"), (spot % 64).cast("int").alias("bit"),
    ).select("word", F.expr("shiftleft(one, bit)").alias("mask"))
    found = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(max(1, 2**bits // 64), dtype=np.int64)
    out[found["word"].to_numpy()] = found["mask"].to_numpy()
    return out.tobytes()


def in_map(values: np.ndarray, map_: bytes) -> np.ndarray:
    """Whether each unsigned 64-bit number falls on a set bit of a :func:`bit_map`."""
    words = np.frombuffer(map_, dtype=np.uint64)
    spot = values & np.uint64(len(words) * 64 - 1)
    return (words[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)
