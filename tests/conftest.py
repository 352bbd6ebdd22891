import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquee.operators.clean import TITLE_COLUMNS  # noqa: E402

RAW_COLS = ("title", "release_year", "director", "language", "country", "duration", "budget",
            "box_office", "genre")


@pytest.fixture(scope="session")
def spark():
    from marquee.session import get_session
    s = get_session("local[*]", app="marquee-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def raw(spark):
    """Build a raw all-string frame from dicts (missing keys -> NULL)."""
    def make(*rows, extra=()):
        cols = list(extra) + list(RAW_COLS)
        data = [tuple(r.get(c) for c in cols) for r in rows]
        schema = ", ".join(f"`{c}` string" for c in cols)
        return spark.createDataFrame(data, schema)
    return make


@pytest.fixture
def tmpdir_path(tmp_path):
    return str(tmp_path)


__all__ = ["TITLE_COLUMNS"]
