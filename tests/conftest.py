from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
# Python workers import the package, too.
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)

from bazaarline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests", cpus=4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before: dict[str, str] = {}

    def change(**values: str) -> None:
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def rows():
    """The rows of a small result as sorted tuples."""

    def read(df, *columns: str) -> list[tuple]:
        picked = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in picked.collect()), key=repr)

    return read
