"""Reading tables and cutting lineage through the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the
    session, else the checkpoint folder the caller has set. Only where both are
    unset and the whole session is one local process, a scratch folder is made."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return spark.sparkContext.getCheckpointDir()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lost
    executors cost no recomputation, and nothing before it runs twice."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: Column, n: int) -> Column:
    """``crc32(doc_id as text) mod n`` (a NULL id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def smallest(df: DataFrame, by: Column, n: int, *ties: str) -> DataFrame:
    """``n`` rows with the smallest hash ``by`` (a bigint), ties by columns. On large
    input the rows far beyond the ``n``-th are dropped where they are read, so that
    tasks send the driver about ``2 n`` rows in all and not ``n`` each."""
    keyed = df.withColumn("_hash", by)
    total = df.count()
    if total > 4 * n:
        border = min((1 << 63) - 1, -(1 << 63) + int((1 << 64) * (2 * n + 100) / total))
        keyed = keyed.where(F.col("_hash") < F.lit(border))
    return keyed.orderBy("_hash", *ties).limit(n).drop("_hash")
