import pytest

from hoarfrost.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.default.parallelism": "1",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(folder),
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as plain tuples, sorted for comparison."""
    found = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))
