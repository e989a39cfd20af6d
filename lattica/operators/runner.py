"""Whole batches into a graph: what a batch must be, in which order its parts are written, and what changed.

A batch has nodes and stubs (as the graph's nodes), edges (as the graph's
edges) and claims (universe, anchor_label, anchor_id, type, direction,
other_label or null, owns_other_end).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.operators.graph import EDGE_KEY, NODE_KEY, Graph, struct_fields
from lattica.operators.validate import VIOLATION, violations
from lattica.operators.write import counters, drop_dangling, insert_stubs, merge_edges, merge_nodes, prune_claims, prune_edges, prune_nodes, resolve_edges
from lattica.sources.tables import settled

CLAIM = "universe string, anchor_label string, anchor_id string, type string, direction string, other_label string, owns_other_end boolean"
_CLAIM_KEY = ["universe", "anchor_label", "anchor_id", "type", "direction", "other_label"]


@dataclass(frozen=True)
class Batch:
    nodes: DataFrame
    edges: DataFrame
    stubs: DataFrame
    claims: DataFrame


class RejectedBatch(ValueError):
    """A batch can't be written in this mode or to this universe."""


def batch(nodes: DataFrame, edges: DataFrame, stubs: DataFrame | None = None, claims: DataFrame | None = None) -> Batch:
    """A batch whose missing parts are empty."""
    return Batch(nodes, edges, nodes.limit(0) if stubs is None else stubs, nodes.sparkSession.createDataFrame([], CLAIM) if claims is None else claims)


def _has_values(df: DataFrame) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"props.{f}").isNotNull() for f in struct_fields(df, "props")], F.lit(False))


def check_batch(b: Batch, scope: Sequence[str] = ()) -> DataFrame:
    """Violations of a batch in itself.

    BN: a node's key repeats, among nodes and stubs; BS: a stub has
    properties; BE: an edge repeats; BX: an edge's end is neither node nor stub
    of the batch; BC: a claim repeats; BA: a claim's anchor is no node of the
    batch; BO: a claim owns ends of a class outside ``scope``.
    """
    spark = b.nodes.sparkSession
    out = spark.createDataFrame([], VIOLATION)
    keys = b.nodes.select(*NODE_KEY).unionByName(b.stubs.select(*NODE_KEY))
    twice = keys.groupBy(*NODE_KEY).agg(F.count("*").alias("_n")).where("_n > 1")
    out = out.unionByName(violations(twice, "BN", "id", F.col("_n"), "a node's key repeats"))
    out = out.unionByName(violations(b.stubs.where(_has_values(b.stubs)), "BS", None, F.lit(None), "a stub has properties"))
    edges = b.edges.groupBy(*EDGE_KEY).agg(F.count("*").alias("_n")).select("*", F.col("src_label").alias("key_label"), F.col("src_id").alias("id"))
    out = out.unionByName(violations(edges.where("_n > 1"), "BE", "type", F.col("type"), "an edge repeats"))
    for side in ("src", "dst"):
        ends = edges.select("universe", F.col(f"{side}_label").alias("_l"), F.col(f"{side}_id").alias("_i"), "key_label", "id", "type")
        known = keys.select(F.col("universe").alias("_ku"), F.col("key_label").alias("_kl"), F.col("id").alias("_ki"))
        lost = ends.join(known, (F.col("universe") == F.col("_ku")) & (F.col("_l") == F.col("_kl")) & (F.col("_i") == F.col("_ki")), "left_anti")
        out = out.unionByName(violations(lost, "BX", side, F.concat_ws("/", "_l", "_i"), "an edge's end is not in the batch"))
    claims = b.claims.withColumn("key_label", F.col("anchor_label")).withColumn("id", F.col("anchor_id"))
    again = claims.groupBy(*_CLAIM_KEY, "key_label", "id").agg(F.count("*").alias("_n")).where("_n > 1")
    out = out.unionByName(violations(again, "BC", "type", F.col("type"), "a claim repeats"))
    adrift = claims.join(b.nodes.select(*NODE_KEY), NODE_KEY, "left_anti")
    out = out.unionByName(violations(adrift, "BA", "type", F.col("type"), "a claim's anchor is not in the batch"))
    beyond = claims.where(F.col("owns_other_end") & ~F.coalesce(F.col("other_label").isin(list(scope)), F.lit(False)))
    return out.unionByName(violations(beyond, "BO", "type", F.col("other_label"), "a claim owns ends outside the scope"))


def claim_rows(b: Batch, direction: str) -> tuple[DataFrame, DataFrame]:
    """(claims, kept) of one direction, as pruning takes them: kept are the other ends that the batch itself gives each claimed anchor."""
    near, far = ("src", "dst") if direction == "out" else ("dst", "src")
    claims = b.claims.where(F.col("direction") == direction).drop("direction")
    kept = b.edges.select("universe", "type", F.col(f"{near}_label").alias("anchor_label"), F.col(f"{near}_id").alias("anchor_id"), F.col(f"{far}_label").alias("other_label"), F.col(f"{far}_id").alias("other_id"))
    return claims, kept.join(claims.select("universe", "type", "anchor_label", "anchor_id").distinct(), ["universe", "type", "anchor_label", "anchor_id"], "left_semi")


def _refuse(found: bool, why: str) -> None:
    if found:
        raise RejectedBatch(why)


def write_batch(graph: Graph, b: Batch, universe: str, ontology_labels: Sequence[str], mode: str = "upsert", scope: Sequence[str] = ()) -> tuple[Graph, DataFrame]:
    """The graph with the batch in it, and one row of what changed: nodes and edges created, deleted and kept.

    upsert: nodes, stubs, claims out, claims in, edges. sync: nodes replace
    their properties, and what the scope's labels hold beyond the batch goes;
    a sync takes neither stubs nor claims. Rows of another universe, and any
    other mode, are refused. Each step's result is written to the scratch folder.
    """
    _refuse(mode not in ("upsert", "sync"), f"there is no mode {mode}")
    for part in (b.nodes, b.stubs, b.edges, b.claims):
        _refuse(not part.where(~F.col("universe").eqNullSafe(F.lit(universe))).isEmpty(), f"the batch has rows of other universes than {universe}")
    if mode == "sync":
        _refuse(not b.stubs.isEmpty(), "a sync takes no stubs")
        _refuse(not b.claims.isEmpty(), "a sync takes no claims")
        nodes = merge_nodes(graph.nodes, b.nodes, ontology_labels, replace=True)
        pruned = settled(prune_nodes(Graph(nodes, graph.edges), scope, b.nodes))
        left = Graph(pruned.nodes, prune_edges(pruned, scope, b.edges))
        after = Graph(left.nodes, merge_edges(left, b.edges, replace=True))
    else:
        after = settled(Graph(insert_stubs(merge_nodes(graph.nodes, b.nodes, ontology_labels), b.stubs), graph.edges))
        owners = b.nodes.unionByName(b.stubs)
        for direction in ("out", "in"):
            claims, kept = claim_rows(b, direction)
            if not claims.isEmpty():
                after = settled(prune_claims(after, claims, kept, owners, direction))
        after = Graph(after.nodes, merge_edges(after, b.edges))
    after = settled(after)
    return after, report(graph, after)


def report(before: Graph, after: Graph) -> DataFrame:
    """One row: nodes_created, nodes_deleted, nodes_kept, edges_created, edges_deleted, edges_kept."""
    of = lambda kind, a, b, key: counters(a, b, key).select(*[F.col(c).alias(f"{kind}_{c}") for c in ("created", "deleted", "kept")])
    nodes, edges = of("nodes", before.nodes, after.nodes, NODE_KEY), of("edges", before.edges, after.edges, EDGE_KEY)
    return nodes.withColumn("_k", F.lit(1)).join(edges.withColumn("_k", F.lit(1)), "_k").drop("_k")  # one row each


def add_reports(reports: Sequence[DataFrame]) -> DataFrame:
    """One row: field by field the sum of several reports."""
    rows = reduce(DataFrame.unionByName, reports)
    return rows.agg(*[F.sum(c).alias(c) for c in rows.columns])


def unique_ids(nodes: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Violations UQ of the constraint that an id is unique among the nodes of a universe that have a label, for each of ``labels``."""
    own = F.explode(F.array_intersect("labels", F.array(*map(F.lit, labels))))
    twice = nodes.select("universe", "id", own.alias("key_label")).groupBy("universe", "key_label", "id").agg(F.count("*").alias("_n")).where("_n > 1")
    return violations(twice, "UQ", "id", F.col("_n"), "an id repeats within a label")


def lost_edges(graph: Graph, edges: DataFrame) -> DataFrame:
    """Batch edges that a write would drop, since an end is missing."""
    found = resolve_edges(graph.nodes, edges).select("universe", "type", "src_id", "dst_id").distinct()
    return edges.join(found, ["universe", "type", "src_id", "dst_id"], "left_anti")


__all__ = ["Batch", "RejectedBatch", "add_reports", "batch", "check_batch", "claim_rows", "drop_dangling", "lost_edges", "report", "unique_ids", "write_batch"]
