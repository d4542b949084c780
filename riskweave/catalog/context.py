"""Shared inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweave import rules
from riskweave.fixtures import raw_feeds
from riskweave.operators.feeds import valid_rows
from riskweave.operators.graph import Graph, build_edges, build_graph, clean_feeds, nodes_from
from riskweave.session import scratch_path

_GRAPHS: dict[tuple[str, str], str] = {}
_ROWS: dict[tuple[str, str, str], DataFrame] = {}


def feed(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return raw_feeds(spark, sf_dir)[dataset]


def rows(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Cleaned rows of a feed; the plan is made once, the data is not held."""
    known = (spark.sparkContext.applicationId, sf_dir, dataset)
    if known not in _ROWS:
        cut = rules.BLACKLIST_CUT if dataset == "blacklist_log" else None
        _ROWS[known] = valid_rows(dataset, feed(spark, sf_dir, dataset), cut)
    return _ROWS[known]


def fresh_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """The graph as a plan over the feeds."""
    return build_graph(raw_feeds(spark, sf_dir), rules.BLACKLIST_CUT)


def graph(spark: SparkSession, sf_dir: str) -> Graph:
    """The graph as written tables, built once per application and input.

    The nodes are made from the edges as written, so that feeds are aggregated to edges once.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _GRAPHS:
        path = scratch_path(spark, "graph")
        cleaned = clean_feeds(raw_feeds(spark, sf_dir), rules.BLACKLIST_CUT)
        build_edges(cleaned).write.parquet(f"{path}/edges")
        nodes_from(spark.read.parquet(f"{path}/edges"), cleaned).write.parquet(f"{path}/nodes")
        _GRAPHS[known] = path
    path = _GRAPHS[known]
    return Graph(spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges"))
