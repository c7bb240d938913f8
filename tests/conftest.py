import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = get_spark("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(shared),
        "spark.sql.warehouse.dir": str(shared / "warehouse"),
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, NULLs first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        found = [tuple(r) for r in picked.collect()]
        return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect
