from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyloom.session import build_session, staging_path  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="tallyloom-tests-")
    conf = {"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": f"{shared}/warehouse"}
    session = build_session("local[*]", app_name="tallyloom-tests", shuffle_partitions=8, extra_conf=conf)
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark, request):
    """A fresh folder under the session's shared folder for one test."""
    return staging_path(spark, request.node.name.replace("[", "_").replace("]", "_"))


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns by default)."""
    names = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=natural)


def natural(row):
    """Sort key for tuples that may hold nulls (nulls last)."""
    return tuple((True, 0) if v is None else (False, v) for v in row)
