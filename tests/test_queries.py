"""Registered queries against the DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as ent
from tests.oracle_harness import canon, duck

SF = "/root/testdata/sf0.001"
SUBSET = ["listings_adapter", "clean_union", "land_caps", "removal_audit", "describe_price",
          "corr_matrix", "yearly_median_yoy", "knn_suburbs", "nearest_stop", "ks_drift",
          "time_split", "feature_matrix", "interval_post", "segment_errors", "price_text_parse",
          "offence_rate", "rail_stops_semi", "payload_explode", "payload_html", "scatter_samples", "interval_segments", "change_events_batch",
          "change_stream", "change_stream_stateful", "csv_dialect_scan", "boundary_resume",
          "enrich_listings", "ks_drift_pvalues"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    df = ent.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    scols = [c.lower() for c in df.columns]
    res = con.execute(ent.oracle_sql()[name])
    dcols = [d[0].lower() for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert canon(scols, srows) == canon(dcols, drows)


def test_every_oracle_has_a_query():
    assert set(ent.oracle_sql()) <= set(ent.queries())


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert df.columns == ["Suburb", "n", "median_price"]
