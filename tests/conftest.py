"""Shared fixtures: one local SparkSession per test run, with its own
checkpoint folder (set only because a local session has none)."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cardlake.session import ensure_conf

    scratch = tempfile.mkdtemp(prefix="cardlake-tests-", dir="/tmp")
    s = (SparkSession.builder.master("local[4]").appName("cardlake-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", f"{scratch}/ckpt")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_conf(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def scratch(spark):
    from cardlake.session import checkpoint_root
    return checkpoint_root(spark)


def raw_frame(spark, table: str, rows: list[dict]):
    """A raw-layer DataFrame: every column of the raw schema, missing ones
    NULL, `_seq` = list position."""
    from cardlake.sources.csv_io import RAW_SCHEMAS, with_seq

    schema = with_seq(RAW_SCHEMAS[table])
    data = [tuple(i if f.name == "_seq" else r.get(f.name) for f in schema.fields) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema)
