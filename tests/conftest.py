import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from larkmetric.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows as sorted tuples, NULL first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t)
        )

    return collect


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    saved = {}

    def set_all(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
