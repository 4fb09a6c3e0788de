"""Report layout, text-file scan, table sinks, jobs and streaming ingest."""

import os

from conftest import F1
from termsim import query_frame, read_corpus, report_lines, similar_terms
from termsim.plans import check_job, lookup_job, matrix_job, write_lookup, write_matrix
from termsim.streaming import append_corpus, read_corpus_stream


def test_report_layout(spark, lines):
    c = lines(F1)
    qs = ["want", "cake"]
    lines_ = report_lines(query_frame(spark, qs), similar_terms(c, qs, pattern=None, n=5))
    text = [r["line"] for r in lines_.orderBy("pos", "line_no").collect()]
    assert text[0] == "=" * 128
    assert text[1] == "FOUND   want"
    assert text[2] == "RANK    " + "TERM".ljust(64) + "COSINE SIMILARITY"
    assert text[3] == "1       " + "A".ljust(64, ".") + "0.800000000"
    assert text[4] == "2       " + "I".ljust(64, ".") + "0.624695048"
    assert text[5] == "=" * 128
    assert text[6] == "No term similar to cake has been found."
    assert text[7] == "=" * 128
    assert len(text) == 8


def test_long_term_is_not_cut(spark, lines):
    long = "x" * 70
    c = lines([f"D1 a {long}", "D2 a b", "D3 c"])
    out = report_lines(query_frame(spark, [long]), similar_terms(c, [long], pattern=None))
    rows = [r["line"] for r in out.orderBy("pos", "line_no").collect()]
    assert rows[3] == "1       " + "a".ljust(64, ".") + "0.707106781"


def test_text_file_scan(spark, tmp_path):
    p = tmp_path / "corpus.txt"
    p.write_text("\r\n".join(F1) + "\r\n\r\n")
    c = read_corpus(spark, str(p))
    assert sorted((r["doc_id"], tuple(r["terms"])) for r in c.collect()) == [
        ("D1", ("I", "like", "data", "science")),
        ("D2", ("I", "hate", "data")),
        ("D3", ("I", "want", "A")),
        ("D4", ("A", "data", "like", "B")),
    ]


def test_lookup_and_matrix_jobs_write(spark, tmp_path):
    p = tmp_path / "corpus.txt"
    p.write_text("\n".join(F1) + "\n")
    c = read_corpus(spark, str(p))
    res = lookup_job(spark, c, ["data", "cake"], pattern=None, n=3)
    write_lookup(res, str(tmp_path / "out"))
    report = []
    for name in sorted(os.listdir(tmp_path / "out" / "report")):
        if name.startswith("part-"):
            report += (tmp_path / "out" / "report" / name).read_text().splitlines()
    assert report[1] == "FOUND   data"
    assert report[-2] == "No term similar to cake has been found."
    cells, axis = matrix_job(c, pattern=None)
    write_matrix(cells, axis, str(tmp_path / "m"))
    back = spark.read.parquet(str(tmp_path / "m" / "cells"))
    assert back.count() == 2 * 16 + 8
    verdicts = check_job(back, cells).collect()
    assert all(r["passed"] for r in verdicts)


def test_streaming_ingest_then_lookup(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("\n".join(F1[:2]) + "\n")
    (src / "b.txt").write_text("\n".join(F1[2:]) + "\n")
    table = str(tmp_path / "table")
    q = append_corpus(read_corpus_stream(spark, str(src)), table, str(tmp_path / "ckpt"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    streamed = spark.read.parquet(table)
    a = similar_terms(streamed, ["data"], pattern=None, n=None).collect()
    from termsim.sources.corpus import parse_lines

    batch = parse_lines(spark.createDataFrame([(x,) for x in F1], "value string"))
    b = similar_terms(batch, ["data"], pattern=None, n=None).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_command_line(spark, tmp_path):
    from termsim.plans.cli import main, parse_args

    p = tmp_path / "corpus.txt"
    p.write_text("\n".join(F1) + "\n")
    out = tmp_path / "cli"
    args = parse_args([str(p), "data", "want", "--nofilter", "--max", "--out", str(out)])
    assert args.max is None and args.nofilter
    main([str(p), "data", "want", "cake", "--nofilter", "--max", "2", "--table", "--out", str(out)])
    ranked = spark.read.parquet(str(out / "ranked"))
    assert ranked.count() == 4
    report = []
    for name in sorted(os.listdir(out / "report")):
        if name.startswith("part-"):
            report += (out / "report" / name).read_text().splitlines()
    assert "No term similar to cake has been found." in report
    assert spark.read.parquet(str(out / "matrix" / "cells")).count() == 40


def test_materialize_under_checkpoint_dir(spark, lines):
    from termsim.plans import materialize
    from termsim.session import checkpoint_dir

    c = lines(F1)
    ranked = similar_terms(c, ["data"], pattern=None, n=None)
    back = materialize(ranked, "ranked")
    base = checkpoint_dir(spark).removeprefix("file:").lstrip("/")
    assert base in back.inputFiles()[0] and "/termsim/ranked-" in back.inputFiles()[0]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, ranked.collect()))


def test_streaming_from_many_triggers(spark, tmp_path):
    src = tmp_path / "in2"
    src.mkdir()
    (src / "a.txt").write_text("\n".join(F1) + "\n")
    table = str(tmp_path / "table2")
    q = append_corpus(read_corpus_stream(spark, str(src), max_files_per_trigger=1), table, str(tmp_path / "ckpt2"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(table).count() == 4


def test_command_line_filter_search_and_length(spark, tmp_path):
    from termsim.plans.cli import main

    p = tmp_path / "corpus2.txt"
    p.write_text("\n".join(F1) + "\n")
    out = tmp_path / "cli2"
    main([str(p), "data", "I", "--filter", "^[a-zA-Z]", "--search", "^[a-z]", "--original-doc-len",
          "--max", "3", "--out", str(out)])
    got = sorted(map(tuple, spark.read.parquet(str(out / "ranked")).collect()))
    from termsim.sources.corpus import read_corpus

    direct = similar_terms(read_corpus(spark, str(p)), ["data", "I"], pattern="^[a-zA-Z]",
                           length="original", search="^[a-z]", n=3)
    assert got and got == sorted(map(tuple, direct.collect()))


def test_command_line_starts_as_a_script(tmp_path):
    import os
    import subprocess
    import sys

    script = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "termsim", "plans", "cli.py")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, script, "--help"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "--nofilter" in done.stdout
