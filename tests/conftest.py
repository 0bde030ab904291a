import contextlib
import io
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from veritally.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def rows(df, *order):
    """Rows as tuples, sorted by the given columns or by all."""
    got = [tuple(r) for r in df.collect()]
    keys = [df.columns.index(c) for c in order] or range(len(df.columns))
    return sorted(got, key=lambda r: tuple((r[i] is not None, r[i]) for i in keys))
