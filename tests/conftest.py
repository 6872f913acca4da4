import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from orderlens.schema import RAW_LINES  # noqa: E402
from orderlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_lines(spark):
    """Order lines from short tuples; dates as text."""

    def make(*rows):
        def at(text):
            return datetime.fromisoformat(text) if text else None

        return spark.createDataFrame([(*r[:4], at(r[4]), *r[5:]) for r in rows], RAW_LINES)

    return make


def rows(df, *columns):
    """Rows as tuples, in the order of ``columns``, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
