"""Payloads by day: what is read, and that landing again adds nothing."""

from datetime import date, datetime

import pytest

from broadsheet.plans.catalog import QUERIES
from broadsheet.settings import Settings
from broadsheet.sources import landing
from broadsheet.sources.payload_table import PayloadTable
from tests.conftest import SMALL

ROWS = [(n, f'{{"articles": [{{"title": "t{n}", "url": "u{n}"}}]}}', date(2024, 1, 20 + n // 2)) for n in range(12)]


@pytest.fixture()
def landed(spark, tmp_path):
    table = PayloadTable(spark, str(tmp_path))
    table.land(spark.createDataFrame(ROWS, "payload_no BIGINT, payload STRING, ingest_day DATE"), "gdelt")
    return table


def numbers(df):
    return sorted(row["payload_no"] for row in df.collect())


def test_window(landed):
    settings = Settings(as_of=datetime(2024, 1, 30, 12), lookback_days=7)
    assert numbers(landed.read("gdelt", settings)) == list(range(6, 12))
    assert numbers(landed.read("gdelt", settings, slack=2)) == list(range(2, 12))
    assert landing.gdelt_items(landed.read("gdelt", settings), settings).count() == 6


def test_landing_again_replaces_days(spark, landed):
    again = spark.createDataFrame([(40, "{}", date(2024, 1, 21))], "payload_no BIGINT, payload STRING, ingest_day DATE")
    for _ in range(2):
        landed.land(again, "gdelt")
    settings = Settings(as_of=datetime(2024, 1, 30), lookback_days=30)
    assert numbers(landed.read("gdelt", settings)) == [0, 1, *range(4, 12), 40]


def test_days_of_a_table(spark, landed):
    days = spark.createDataFrame([(date(2024, 1, 21),), (date(2024, 1, 21),), (date(2023, 1, 1),), (None,)], "day DATE")
    assert numbers(landed.read_days("gdelt", days)) == [2, 3]


def scan(spark, name):
    text = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.split("\n") if "FileScan" in line and "ingest_day#" in line]


def test_partitions_are_pruned(spark):
    fixed = scan(spark, "landed_window")
    assert fixed and all("ingest_day" in line.split("PartitionFilters: [")[1].split("PushedFilters")[0] for line in fixed)


def test_partitions_are_pruned_by_a_table(spark):
    assert any("dynamicpruning" in line.split("PartitionFilters: [")[1] for line in scan(spark, "landed_days"))
