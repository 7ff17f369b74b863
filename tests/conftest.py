import os
import sys
from collections import namedtuple
from datetime import date, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from setstride.operators.layout import build_steps  # noqa: E402
from setstride.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
RAW = "series_id int, step_id long, ts date, items array<int>, special int, amount double"
Step = namedtuple("Step", "series step day items special")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    return session


def make_steps(spark, steps, block=None):
    """StepTable from (series, step_id, day number, items, special)."""
    first = date(2024, 1, 1)
    rows = [(s.series, s.step, first + timedelta(days=s.day), sorted(s.items), s.special, None) for s in steps]
    return build_steps(spark.createDataFrame(rows, RAW), block=block)
