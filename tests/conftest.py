from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from adrlens.schemas import REPORT_COLUMNS, string_schema  # noqa: E402
from adrlens.session import local_session  # noqa: E402
from adrlens.sources.case_tables import CaseTables  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "adrlens-tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})


@pytest.fixture(scope="session")
def make_tables(spark):
    """Case tables from rows given as dicts; columns left out are null."""
    def build(**rows) -> CaseTables:
        frames = {}
        for name, columns in REPORT_COLUMNS.items():
            names = [*columns, "year_quarter"]
            data = [tuple(r.get(c) for c in names) for r in rows.get(name, [])]
            frames[name] = spark.createDataFrame(data, string_schema(names))
        return CaseTables(**frames)

    return build


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
