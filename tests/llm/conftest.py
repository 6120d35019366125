import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

from vigil.llm.base import set_batch_rows  # noqa: E402
from vigil.session import build_session, checkpoint_dir  # noqa: E402

DOC = "doc_id long, text string, lang string, source string, n_chars long, words string, comp int"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4)
    checkpoint_dir(s)
    set_batch_rows(s)
    yield s


@pytest.fixture()
def docs(spark):
    """Make a documents table (with two columns of clashing names) from (doc_id, text[, source[, lang]])."""
    def make(rows):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s",
                 None if r[1] is None else len(r[1]), "x", 1) for r in rows]
        return spark.createDataFrame(full, DOC)
    return make
