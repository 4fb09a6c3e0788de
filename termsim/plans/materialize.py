"""Cut a lineage by writing a table to the cluster's shared checkpoint folder.

For callers that reuse an intermediate (document vectors, TF table, ranked
results) across many jobs: the rows are written once as parquet under
``spark.checkpoint.dir`` and read back, so later jobs and recomputation after
a lost executor start from the written files, not from the whole plan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from termsim.session import checkpoint_dir


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` under ``<folder>/termsim/<name>-<id>`` (default folder:
    ``spark.checkpoint.dir``) and return the table read back. Raises if there is
    neither (a machine-local temporary folder is not safe on a cluster)."""
    spark = df.sparkSession
    base = folder or checkpoint_dir(spark)
    if not base:
        raise ValueError("set spark.checkpoint.dir (a shared folder) to materialize tables")
    path = f"{base.rstrip('/')}/termsim/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
