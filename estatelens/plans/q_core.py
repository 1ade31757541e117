"""Registered query: the LISTINGS adapter itself (input of most queries)."""

from estatelens.plans.registry import register
from estatelens.sources import listings_adapter as la


@register("listings_adapter", la.duckdb_sql())
def q_listings(spark, sf_dir):
    return la.listings(spark, sf_dir)
