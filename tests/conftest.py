import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from termsim.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        cores=4, shuffle_partitions=4, app="termsim-tests", checkpoint=tempfile.mkdtemp(prefix="run-")
    )
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Corpus from text lines (one document per line)."""
    from termsim.sources.corpus import parse_lines

    def make(rows):
        return parse_lines(spark.createDataFrame([(r,) for r in rows], "value string"))

    return make


F1 = ["D1 I like data science", "D2 I hate data", "D3 I want A", "D4 A data like B"]

F2 = [
    "B1 dis_a_dis gene_x_gene foo bar",
    "B2 dis_a_dis dis_b_dis baz",
    "B3 gene_x_gene gene_x_gene dis_b_dis qux qux",
    "B4 gene_y_gene, dis_b_dis",
    "B5 plain words only",
    "B6",
]
