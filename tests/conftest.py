from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bidlens.plans.views import NOW  # noqa: E402
from bidlens.rules import load_rules  # noqa: E402
from bidlens.schema import conform  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rules():
    return load_rules()


@pytest.fixture(scope="session")
def now():
    return NOW


BASE = {
    "bid_number": "GEM/2026/B/9000001",
    "source_url": "https://bidplus.gem.gov.in/showbidDocument/9000001",
    "title": "Purchase of Laptop sets for the records room",
    "category": "Laptop - Business",
    "buyer_organization": "Department of Higher Education, Government of Jharkhand",
    "buyer_address": "Ashok Marg Annexe, Hinoo, Ranchi, Jharkhand 834002",
    "delivery_location": "Ranchi, Jharkhand",
    "portal_status": "", "listing_text": "", "doc_text": "", "ra_enabled": "",
    "quantity": 45.0, "quantity_unit": "Nos", "estimated_value": None, "portal_emd_amount": None, "portal_epbg_pct": None,
    "bid_end_at": "2026-09-10 15:00:00",
}
TYPES = {"quantity": "double", "estimated_value": "double", "portal_emd_amount": "double", "portal_epbg_pct": "double"}


@pytest.fixture(scope="session")
def make(spark):
    """Bids that differ from one valid bid only in what a test states; ``id`` counts them."""

    def build(*overrides: dict):
        rows = [{**BASE, **o, "id": i} for i, o in enumerate(overrides)]
        names = [*BASE, "id"]
        ddl = ", ".join(f"{n} {TYPES.get(n, 'int' if n == 'id' else 'string')}" for n in names)
        df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ddl)
        return conform(df.withColumn("bid_end_at", df.bid_end_at.cast("timestamp_ntz")))

    return build


@pytest.fixture(scope="session")
def rows():
    """Collected rows in the order the bids were given."""
    return lambda df: sorted(df.collect(), key=lambda r: r["id"])
