"""Streaming corpus ingest (same parsing as the batch scan)."""

from termsim.streaming.corpus_stream import append_corpus, read_corpus_stream

__all__ = ["append_corpus", "read_corpus_stream"]
