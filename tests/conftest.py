import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidegrid.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build(
        "tests", "local[4]", spark_sql_shuffle_partitions=4, spark_ui_enabled="false",
        spark_driver_memory="4g", spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Collect a small result as a list of tuples of the named columns, sorted."""

    def collect(df, *cols):
        out = [tuple(r) for r in df.select(*cols).collect()]
        return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))

    return collect
