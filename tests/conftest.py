import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from steploom.schemas import ACTUALS  # noqa: E402
from steploom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture(scope="session")
def series(spark):
    """Actuals of one or more regions from lists of values, one per step."""

    def build(start="2026-01-01", step_hours=1, **values):
        begin = datetime.fromisoformat(start)
        rows = [
            (region, f"{region} total", begin + timedelta(hours=step_hours * i), v)
            for region, column in values.items()
            for i, v in enumerate(column)
        ]
        return spark.createDataFrame(rows, ACTUALS)

    return build
