"""Corpus ingest with Structured Streaming.

The reference reads one corpus file in batch; it has no streaming. This is
the same line scan (``parse_lines``) over a folder that receives new corpus
files, appended exactly once to a parquet table through the file sink and its
checkpoint. Lookups then read that table as an ordinary corpus. No custom
state: each line is a document on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from termsim.sources.corpus import parse_lines


def read_corpus_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming document rows ``(doc_id, terms)`` from text files arriving in
    ``folder``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_lines(reader.load(folder))


def append_corpus(stream: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Append streamed documents to a parquet corpus table (exactly once).

    ``checkpoint`` is a folder of this stream's own, on storage that the cluster
    shares (e.g. under ``spark.checkpoint.dir``)."""
    return (
        stream.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .start()
    )
