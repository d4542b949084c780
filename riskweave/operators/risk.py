"""Rule-based risk on the identifier graph."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave import rules
from riskweave.functions.weights import edge_weight
from riskweave.operators.association import association_scores
from riskweave.operators.graph import Graph, edge_ends
from riskweave.operators.skew import hot_keys, salted_lookup
from riskweave.session import cut_lineage, written_table

NODE = ["node_type", "key"]
NEIGHBOUR = ["n_type", "n_key"]


def neighbour_edges(edges: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """Each edge seen from both ends, a self-loop once: node, neighbour, relation, time.

    With ``types``, of edges between nodes of these types only; others are not read where files hold none.
    """
    if types is not None:
        edges = edges.filter(F.col("src_type").isin(*types) & F.col("dst_type").isin(*types))
    ends = F.array(
        F.struct(
            F.col("src_type").alias("node_type"),
            F.col("src_key").alias("key"),
            F.col("dst_type").alias("n_type"),
            F.col("dst_key").alias("n_key"),
        ),
        F.struct(
            F.col("dst_type").alias("node_type"),
            F.col("dst_key").alias("key"),
            F.col("src_type").alias("n_type"),
            F.col("src_key").alias("n_key"),
        ),
    )
    return edges.select(F.inline(F.array_distinct(ends)), "rel", F.col("last_seen_ts").alias("last_seen"))


def overdue_orders(nodes: DataFrame) -> DataFrame:
    status = F.upper(F.coalesce("order_status", F.lit("")))
    return nodes.filter((F.col("node_type") == "order") & (status == "OVERDUE")).select(*NODE)


def near_overdue_order(graph: Graph, types: Sequence[str] | None = None) -> DataFrame:
    """Nodes with at least one overdue order as neighbour; of the given types only, which orders are among."""
    late = overdue_orders(graph.nodes).toDF(*NEIGHBOUR)
    around = neighbour_edges(graph.edges, types).filter(F.col("n_type") == "order")
    return around.join(late, NEIGHBOUR, "left_semi").select(*NODE).distinct()


def base_risk(graph: Graph, via_orders: bool = True) -> DataFrame:
    """Status risk plus association risk of every risk node."""
    nodes = graph.nodes.filter(F.col("node_type").isin(*rules.RISK_NODE_TYPES)).select(
        *NODE, "updated_at", "is_blacklisted", "order_status"
    )
    near = near_overdue_order(graph, rules.RISK_NODE_TYPES).withColumn("_near", F.lit(True))
    scores = association_scores(graph, via_orders)
    late = (F.col("node_type") == "order") & (F.upper(F.coalesce("order_status", F.lit(""))) == "OVERDUE")
    status_risk = (
        F.when(F.col("is_blacklisted"), F.lit(rules.BLACKLISTED_RISK))
        .when(late, F.lit(rules.OVERDUE_RISK))
        .when(F.col("_near"), F.lit(rules.OVERDUE_RISK))
        .otherwise(F.lit(0.0))
    )
    association = F.coalesce("association_risk", F.lit(0.0))
    return (
        nodes.join(near, NODE, "left")
        .join(scores, NODE, "left")
        .select(
            *NODE,
            "updated_at",
            status_risk.alias("status_risk"),
            association.alias("association_risk"),
            (status_risk + association).alias("base_risk"),
        )
    )


def weighted_edges(graph: Graph) -> DataFrame:
    """Edges seen from both ends with the neighbour's update time and the weight."""
    nodes = graph.nodes.select(F.col("node_type").alias("n_type"), F.col("key").alias("n_key"), "updated_at")
    sides = neighbour_edges(graph.edges)
    joined = salted_lookup(sides, nodes, NEIGHBOUR, ["key", "rel"])
    return joined.withColumn("weight", edge_weight(F.col("rel"), F.col("last_seen"), F.col("updated_at")))


def _levels(sides: DataFrame, targets: DataFrame, k: int) -> list[DataFrame]:
    """Nodes whose risk is needed per round: targets last, then their neighbours. Each is written, as it is read several times."""
    levels = [written_table(targets.select(*NODE).distinct(), "risk-level")]
    for _ in range(k - 1):
        around = sides.join(levels[0], NODE, "left_semi")
        further = around.select(F.col("n_type").alias("node_type"), F.col("n_key").alias("key")).distinct()
        levels.insert(0, written_table(further, "risk-level"))
    return levels


def k_hop_risk(
    graph: Graph, k: int = 2, via_orders: bool = True, targets: DataFrame | None = None
) -> DataFrame:
    """Risk after ``k`` rounds of weighted neighbour sums.

    Round 0 is the base risk. Each round sums weight times the neighbours' previous
    risk; a node without any edge keeps its base. One join and one map-side combined
    sum per round, over all nodes at once. With ``targets`` each round touches only
    the nodes that the next one needs; targets not in the graph score zero.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    ends = edge_ends(graph.edges).filter(F.col("node_type").isin(*rules.RISK_NODE_TYPES))
    linked = ends.select(*NODE).distinct().withColumn("_linked", F.lit(True))
    base = base_risk(graph, via_orders).join(linked, NODE, "left")
    base = cut_lineage(base.select(*NODE, "updated_at", "base_risk", F.coalesce("_linked", F.lit(False)).alias("linked")))
    current = base.select(*NODE, "updated_at", F.col("base_risk").alias("risk"))

    if k > 0:
        sides = neighbour_edges(graph.edges, rules.RISK_NODE_TYPES)
        hot = cut_lineage(hot_keys(sides, NEIGHBOUR))
        levels = _levels(sides, targets, k) if targets is not None else [None] * k
        for level in levels:
            part = sides if level is None else sides.join(level, NODE, "left_semi")
            previous = current.withColumnsRenamed({"node_type": "n_type", "key": "n_key"})
            met = salted_lookup(part, previous, NEIGHBOUR, ["key", "rel"], how="inner", hot=hot)
            term = edge_weight(F.col("rel"), F.col("last_seen"), F.col("updated_at")) * F.col("risk")
            sums = met.groupBy(*NODE).agg(F.sum(term).alias("_sum"))
            risk = F.when(F.col("linked"), F.coalesce("_sum", F.lit(0.0))).otherwise(F.col("base_risk"))
            asked = base if level is None else base.join(level, NODE, "left_semi")
            current = asked.join(sums, NODE, "left").select(*NODE, "updated_at", risk.alias("risk"))
    scored = current.select(*NODE, "risk")
    if targets is None:
        return scored
    wanted = targets.select(*NODE).distinct()
    return wanted.join(scored, NODE, "left").withColumn("risk", F.coalesce("risk", F.lit(0.0)))
