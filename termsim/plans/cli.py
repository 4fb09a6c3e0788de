"""Command line with the reference's options, for ``spark-submit``.

    spark-submit termsim/plans/cli.py CORPUS [TERM ...] [--nofilter] [--filter P]
        [--original-doc-len] [--search R] [--max [M]] [--table] --out DIR

Writes ``DIR/ranked`` (parquet), ``DIR/report`` (text) and with ``--table``
``DIR/matrix/{cells,axis}``. The session comes from ``spark-submit``.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

if not __package__:  # run as a script: its own folder is on the path, not the package's
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from termsim.functions.text import DEFAULT_PATTERN
from termsim.plans.jobs import lookup_job, matrix_job, write_lookup, write_matrix
from termsim.sources.corpus import read_corpus


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Term similarity on Spark.")
    p.add_argument("corpus", metavar="CORPUS", help="corpus path (files with one document per line)")
    p.add_argument("terms", metavar="TERM", nargs="*", help="query terms")
    p.add_argument("--out", required=True, help="output folder")
    p.add_argument("--table", action="store_true", help="also write the similarity table")
    p.add_argument("--nofilter", action="store_true", help="no term filter")
    p.add_argument("--filter", default=DEFAULT_PATTERN, help="term pattern (Java regex, found anywhere)")
    p.add_argument("--original-doc-len", action="store_true", help="TF over the original document length")
    p.add_argument("--search", default=None, help="keep only result terms matching this pattern")
    p.add_argument("--max", metavar="M", type=int, nargs="?", const=None, default=5, help="top M (bare: all)")
    p.add_argument("--merge-duplicate-ids", action="store_true", help="merge lines with the same id")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    corpus = read_corpus(spark, args.corpus, "merge" if args.merge_duplicate_ids else "error")
    pattern = None if args.nofilter else args.filter
    length = "original" if args.original_doc_len else "filtered"
    if args.table:
        cells, axis = matrix_job(corpus, pattern, length)
        write_matrix(cells, axis, f"{args.out}/matrix")
    result = lookup_job(spark, corpus, args.terms, pattern, length, args.search, args.max)
    write_lookup(result, args.out)


if __name__ == "__main__":
    main(sys.argv[1:])
