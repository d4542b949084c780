"""Relation weights and time decay."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave import rules
from riskweave.functions.timeparse import seconds_between


def lookup(mapping: dict[str, float], key: Column, default: float) -> Column:
    """Constant map lookup with a default."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), F.lit(default))


def relation_weight(rel: Column) -> Column:
    return lookup(rules.RELATION_WEIGHTS, rel, rules.DEFAULT_RELATION_WEIGHT)


def time_decay(rel: Column, last_seen: Column, neighbour_updated: Column) -> Column:
    """One at age zero, a tenth at the relation's horizon; one when a time is missing."""
    horizon = lookup(rules.DECAY_DAYS, rel, rules.DEFAULT_DECAY_DAYS)
    age_days = F.greatest(F.lit(0.0), seconds_between(last_seen, neighbour_updated) / F.lit(86400.0))
    return F.coalesce(F.pow(F.lit(0.1), age_days / horizon), F.lit(1.0))


def edge_weight(rel: Column, last_seen: Column, neighbour_updated: Column) -> Column:
    return relation_weight(rel) * time_decay(rel, last_seen, neighbour_updated)


def beyond_first(count: Column) -> Column:
    """``max(count - 1, 0)``."""
    return F.greatest(count - 1, F.lit(0))
