from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from aerolap.session import build_session

    s = build_session("local[4]", app="aerolap-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="aerolap-test-")


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def parse(spark, lines):
    from aerolap.sources.csv import parse_concise

    return parse_concise(lines_df(spark, lines))


def flights(spark, lines):
    from aerolap.sources.csv import accepted

    return accepted(parse(spark, lines))
