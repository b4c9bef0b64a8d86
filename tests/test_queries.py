"""Queries against their checking SQL at the smallest scale."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry  # noqa: E402
from bidlens.plans import views  # noqa: E402
from bidlens.catalog.checks import ORACLES  # noqa: E402
from bidlens.catalog.queries import QUERIES  # noqa: E402
from check import compare, duck  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ("A1_listing_cards", "A4_attachments", "A12_document_budget", "B4_gate", "C1_signal_match", "C7_change_detection", "C8_discovery_merge",
          "D5_run_manifest", "E2_ranking", "G1_clean", "H14_required_documents", "I1_classification", "K10_known_profile", "L1_amendment_feed",
          "M5_detailed", "M_report_lines", "N3_parameters", "A14_all_sinks", "verdict_summary")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not here")


def test_every_query_has_checking_sql():
    assert set(QUERIES) == set(ORACLES) & set(QUERIES) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees(spark, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    assert len(got) and compare(got, duck(FOLDER).execute(entry.oracle_sql()[name]).df()) == ""


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_bids_are_dealt_over_tasks_of_bounded_size(spark, monkeypatch):
    """However large the files of the orders are, and after the join with their customers."""
    monkeypatch.setattr(views, "BIDS_PER_TASK", 1_000)
    bids = views.view(spark, "/root/testdata/sf0.01")
    sizes = bids.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert sizes.sum() == 15_000 and len(sizes) == 15 and sizes.max() <= 1_100
