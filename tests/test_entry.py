"""The driver contract, and a selection of queries against their oracles (all of them: `python -m checks.compare`)."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference

SELECTION = [
    "a1_counts_by_cell_hour", "a15_stage_funnel", "f1_crime_type", "f6_occurred_at", "h1_hexagon_cell", "h1_region_sweep",
    "j3_drop_loaded", "j5_densify_table", "l2_l3_l4_fold", "m1_features_dense", "m4_curve_areas", "p12_gold_schema",
    "r2_live_counts", "s9_pick_resource", "v2_v3_validate_raw", "w1_dedup_first", "w7_single_active_model",
]


def test_every_query_has_an_oracle():
    from checks.oracle import oracles
    from checks.queries import QUERIES

    assert set(QUERIES) == set(oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["h3_index", "time_window", "crime_count", "distinct_crime_types"]
    assert df.count() > 0


@pytest.mark.parametrize("name", SELECTION)
def test_oracle(spark, sf, name):
    assert difference(spark, connect(sf), entry.queries()[name], entry.oracle_sql()[name], sf) is None
