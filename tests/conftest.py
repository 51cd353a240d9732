import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from panelweave.session import local_session

    session = local_session(
        "tests", "4", **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("stages")),
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return collect
