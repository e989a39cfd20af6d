"""Graph writes as new snapshots: merge, stubs, sync, prune, claims, purge.

Every function returns new DataFrames and leaves its input as it is. Batches
have nodes (universe, key_label, id, leaf, labels, name, props) and edges like
the graph's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.operators.graph import EDGE_KEY, NODE_KEY, Graph, merge_structs, struct_fields


def _meets(new: str, old: str) -> Column:
    """A reference finds a node by universe, id and membership in its labels."""
    return (F.col(f"{new}.universe") == F.col(f"{old}.universe")) & (F.col(f"{new}.id") == F.col(f"{old}.id")) & F.array_contains(F.col(f"{old}.labels"), F.col(f"{new}.key_label"))


def refuse_repeats(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df``, whose plan raises an error if a key occurs twice: by counts, so no key's rows are gathered."""
    rest = [c for c in df.columns if c not in key]
    once = df.groupBy(*key).agg(F.count("*").alias("_n"), F.any_value(F.struct(*rest)).alias("_r"))
    checked = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("a batch repeats "), F.concat_ws("/", *key)))).otherwise(F.col("_r"))
    return once.select(*key, checked.alias("_r")).select(*key, "_r.*").select(*df.columns)


def merge_nodes(nodes: DataFrame, batch: DataFrame, ontology_labels: Sequence[str], replace: bool = False) -> DataFrame:
    """Inserts or updates nodes.

    A matched node gets the row's labels, loses other labels of the ontology
    and keeps the rest; its properties are merged, or replaced on ``replace``.
    A batch that repeats a key is refused when the result is computed.
    """
    batch = refuse_repeats(batch, NODE_KEY)
    fields = struct_fields(nodes, "props")
    known = F.array(*map(F.lit, ontology_labels)) if ontology_labels else F.array().cast("array<string>")
    rows = batch.alias("n")
    matched = nodes.alias("o").join(rows, _meets("n", "o"), "left")
    hit = F.col("n.id").isNotNull()
    updated = matched.select(
        F.col("o.universe").alias("universe"),
        F.when(hit, F.col("n.key_label")).otherwise(F.col("o.key_label")).alias("key_label"),
        F.col("o.id").alias("id"),
        F.when(hit, F.col("n.leaf")).otherwise(F.col("o.leaf")).alias("leaf"),
        F.when(hit, F.array_union(F.col("n.labels"), F.array_except(F.col("o.labels"), known))).otherwise(F.col("o.labels")).alias("labels"),
        F.coalesce(F.col("n.name"), F.col("o.name")).alias("name"),
        F.when(hit, F.col("n.props") if replace else merge_structs(F.col("n.props"), F.col("o.props"), fields)).otherwise(F.col("o.props")).alias("props"),
    )
    inserted = rows.join(nodes.alias("o"), _meets("n", "o"), "left_anti").select(*nodes.columns)
    return updated.unionByName(inserted)


def insert_stubs(nodes: DataFrame, stubs: DataFrame) -> DataFrame:
    """Adds nodes whose key is free; never changes a node."""
    return nodes.unionByName(stubs.alias("n").join(nodes.alias("o"), _meets("n", "o"), "left_anti").select(*nodes.columns))


def resolve_edges(nodes: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch edges with both ends found, ends named by the nodes' own key labels; others vanish."""
    keys = nodes.select("universe", "key_label", "id", "labels")
    src = keys.select(F.col("universe").alias("_su"), F.col("key_label").alias("_sk"), F.col("id").alias("_si"), F.col("labels").alias("_sl"))
    dst = keys.select(F.col("universe").alias("_du"), F.col("key_label").alias("_dk"), F.col("id").alias("_di"), F.col("labels").alias("_dl"))
    found = batch.join(src, (F.col("universe") == F.col("_su")) & (F.col("src_id") == F.col("_si")) & F.array_contains("_sl", F.col("src_label")))
    found = found.join(dst, (F.col("universe") == F.col("_du")) & (F.col("dst_id") == F.col("_di")) & F.array_contains("_dl", F.col("dst_label")))
    return found.select("universe", "type", F.col("_sk").alias("src_label"), "src_id", F.col("_dk").alias("dst_label"), "dst_id", "props")


def merge_edges(graph: Graph, batch: DataFrame, replace: bool = False) -> DataFrame:
    """Inserts or updates edges by type and ends; properties are merged, or replaced on ``replace``.

    Edges that repeat type and ends in the batch are refused when the result is computed.
    """
    fields = struct_fields(graph.edges, "props")
    new = refuse_repeats(resolve_edges(graph.nodes, batch), EDGE_KEY)
    both = graph.edges.withColumnRenamed("props", "_old").withColumn("_had", F.lit(True)).join(new.withColumnRenamed("props", "_new").withColumn("_has", F.lit(True)), EDGE_KEY, "full")
    merged = F.col("_new") if replace else merge_structs(F.col("_new"), F.col("_old"), fields)
    props = F.when(F.col("_has") & F.col("_had"), merged).when(F.col("_has"), F.col("_new")).otherwise(F.col("_old"))
    return both.select(*EDGE_KEY, props.alias("props"))


def drop_dangling(graph: Graph) -> Graph:
    """Edges whose ends both exist."""
    keys = graph.nodes.select(*NODE_KEY)
    edges = graph.edges
    for side in ("src", "dst"):
        ends = keys.select(F.col("universe"), F.col("key_label").alias(f"{side}_label"), F.col("id").alias(f"{side}_id"))
        edges = edges.join(ends, ["universe", f"{side}_label", f"{side}_id"], "left_semi").select(*EDGE_KEY, "props")
    return Graph(graph.nodes, edges)


def prune_nodes(graph: Graph, scope: Sequence[str], listed: DataFrame) -> Graph:
    """Deletes nodes of the scope's labels that ``listed`` (universe, key_label, id) lacks, with their edges."""
    in_scope = F.arrays_overlap("labels", F.array(*map(F.lit, scope)))
    gone = graph.nodes.where(in_scope).alias("o").join(listed.alias("n"), _meets("n", "o"), "left_anti").select(*NODE_KEY)
    return drop_dangling(Graph(graph.nodes.join(gone, NODE_KEY, "left_anti").select(*graph.nodes.columns), graph.edges))


def prune_edges(graph: Graph, scope: Sequence[str], listed: DataFrame) -> DataFrame:
    """Deletes edges between two nodes of the scope that ``listed`` lacks."""
    inside = graph.nodes.where(F.arrays_overlap("labels", F.array(*map(F.lit, scope)))).select(*NODE_KEY)
    src = inside.select("universe", F.col("key_label").alias("src_label"), F.col("id").alias("src_id"))
    dst = inside.select("universe", F.col("key_label").alias("dst_label"), F.col("id").alias("dst_id"))
    within = graph.edges.join(src, ["universe", "src_label", "src_id"], "left_semi").join(dst, ["universe", "dst_label", "dst_id"], "left_semi")
    stale = within.join(resolve_edges(graph.nodes, listed), EDGE_KEY, "left_anti").select(*EDGE_KEY)
    return graph.edges.join(stale, EDGE_KEY, "left_anti").select(*EDGE_KEY, "props")


def prune_claims(graph: Graph, claims: DataFrame, kept: DataFrame, owners: DataFrame, direction: str) -> Graph:
    """Deletes edges at claimed anchors that the batch doesn't list, and orphans that a claim owns.

    claims: universe, anchor_label, anchor_id, type, other_label (null: any),
    owns_other_end. kept: universe, type, anchor_label, anchor_id, other_label,
    other_id. owners: universe, key_label, id of nodes the batch itself holds.
    All is judged on the graph as it was before.
    """
    near, far = ("src", "dst") if direction == "out" else ("dst", "src")
    c = claims.select(F.col("universe").alias("_u"), "anchor_label", "anchor_id", F.col("type").alias("_t"), F.col("other_label").alias("_o"), "owns_other_end")
    anchors = graph.nodes.select(F.col("universe").alias("_u"), F.col("id").alias("anchor_id"), F.col("key_label").alias("_ak"), F.col("labels").alias("_al"))
    c = c.join(anchors, ["_u", "anchor_id"]).where(F.array_contains("_al", F.col("anchor_label")))
    edges = graph.edges.join(c, (F.col("universe") == F.col("_u")) & (F.col("type") == F.col("_t")) & (F.col(f"{near}_id") == F.col("anchor_id")) & (F.col(f"{near}_label") == F.col("_ak")))
    others = graph.nodes.select(F.col("universe").alias("_ou"), F.col("id").alias("_oi"), F.col("key_label").alias("_ok"), F.col("labels").alias("_ol"))
    edges = edges.join(others, (F.col("universe") == F.col("_ou")) & (F.col(f"{far}_id") == F.col("_oi")) & (F.col(f"{far}_label") == F.col("_ok")))
    edges = edges.where(F.col("_o").isNull() | F.array_contains("_ol", F.col("_o")))
    k = kept.select(F.col("universe").alias("_ku"), F.col("type").alias("_kt"), F.col("anchor_id").alias("_ka"), F.col("other_label").alias("_kl"), F.col("other_id").alias("_ko"))
    stale = edges.join(k, (F.col("_ku") == F.col("universe")) & (F.col("_kt") == F.col("type")) & (F.col("_ka") == F.col("anchor_id")) & (F.col("_ko") == F.col("_oi")) & F.array_contains("_ol", F.col("_kl")), "left_anti")
    gone_edges = stale.select(*EDGE_KEY).distinct()
    orphans = stale.where("owns_other_end").select("universe", F.col("_ok").alias("key_label"), F.col("_oi").alias("id")).distinct().join(owners.select(*NODE_KEY), NODE_KEY, "left_anti")
    nodes = graph.nodes.join(orphans, NODE_KEY, "left_anti").select(*graph.nodes.columns)
    left = graph.edges.join(gone_edges, EDGE_KEY, "left_anti").select(*EDGE_KEY, "props")
    for side in ("src", "dst"):
        ends = orphans.select("universe", F.col("key_label").alias(f"{side}_label"), F.col("id").alias(f"{side}_id"))
        left = left.join(ends, ["universe", f"{side}_label", f"{side}_id"], "left_anti").select(*EDGE_KEY, "props")
    return Graph(nodes, left)


def purge(graph: Graph, universe: str) -> Graph:
    """Deletes a universe: a partition of the nodes, and all edges that touch it."""
    nodes = graph.nodes.where(F.col("universe") != universe)
    return drop_dangling(Graph(nodes, graph.edges.where(F.col("universe") != universe)))


def counters(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: how many rows were created, deleted and kept between two snapshots."""
    both = before.select(*key).distinct().withColumn("_b", F.lit(True)).join(after.select(*key).distinct().withColumn("_a", F.lit(True)), list(key), "full")
    return both.agg(
        F.count_if(F.col("_b").isNull()).alias("created"),
        F.count_if(F.col("_a").isNull()).alias("deleted"),
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("kept"),
    )


def upsert(graph: Graph, nodes: DataFrame, edges: DataFrame, stubs: DataFrame, ontology_labels: Sequence[str]) -> Graph:
    """One batch in upsert mode: owners, then stubs, then edges."""
    written = insert_stubs(merge_nodes(graph.nodes, nodes, ontology_labels), stubs)
    return Graph(written, merge_edges(Graph(written, graph.edges), edges))


def sync(graph: Graph, nodes: DataFrame, edges: DataFrame, scope: Sequence[str], ontology_labels: Sequence[str]) -> Graph:
    """One batch in sync mode: the scope mirrors the batch."""
    merged = merge_nodes(graph.nodes, nodes, ontology_labels, replace=True)
    pruned = prune_nodes(Graph(merged, graph.edges), scope, nodes)
    left = Graph(pruned.nodes, prune_edges(pruned, scope, edges))
    return Graph(left.nodes, merge_edges(left, edges, replace=True))


def dedupe_owners(nodes: DataFrame, order: str = "seq") -> DataFrame:
    """One row per key: an owner's before a stub's, else the first."""
    w = Window.partitionBy(*NODE_KEY).orderBy(F.col("is_owner").desc(), F.col(order))
    return nodes.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def duplicate_keys(df: DataFrame, key: Sequence[str], owner: str) -> DataFrame:
    """Keys that occur more than once, with a sorted list of who has them."""
    return df.groupBy(*key).agg(F.count("*").alias("n"), F.array_sort(F.collect_set(owner)).alias("owners")).where("n > 1")
