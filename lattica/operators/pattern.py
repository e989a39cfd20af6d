"""Graph patterns as joins.

Rows of a match have one struct column per variable, with the node's universe,
label, id, name and props; Catalyst reads only the fields that are used.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.operators.graph import Graph, has_label

_FIELDS = ["universe", "key_label", "id", "name", "labels", "props"]


def scan(graph: Graph, var: str, label: str | None = None, where: Column | None = None, ids: list[str] | None = None) -> DataFrame:
    """Nodes with a label, by key or predicate, as the column ``var``."""
    rows = graph.nodes
    if label:
        rows = rows.where(has_label(label))
    if ids is not None:
        rows = rows.where(F.col("id").isin(ids))
    if where is not None:
        rows = rows.where(where)
    return rows.select(F.struct(*_FIELDS).alias(var))


def _steps(graph: Graph, type_: str | None, direction: str) -> DataFrame:
    edges = graph.edges if type_ is None else graph.edges.where(F.col("type") == type_)
    out = edges.select("universe", "type", F.col("src_label").alias("a_label"), F.col("src_id").alias("a_id"), F.col("dst_label").alias("b_label"), F.col("dst_id").alias("b_id"), "props", F.lit(True).alias("forward"))
    back = edges.select("universe", "type", F.col("dst_label").alias("a_label"), F.col("dst_id").alias("a_id"), F.col("src_label").alias("b_label"), F.col("src_id").alias("b_id"), "props", F.lit(False).alias("forward"))
    return {"out": out, "in": back, "any": out.unionByName(back)}[direction] if direction != "any" else out.unionByName(back)


def expand(graph: Graph, rows: DataFrame, start: str, type_: str | None, end: str, *, direction: str = "out", label: str | None = None, where: Column | None = None, edge: str | None = None, optional: bool = False) -> DataFrame:
    """Follows edges from ``start`` to a new variable ``end``; ``edge`` names a struct of the edge.

    ``optional`` keeps rows without a match, with nulls for what the step
    binds: the step and its conditions are one block, all or nothing.
    """
    target = graph.nodes
    if label:
        target = target.where(has_label(label))
    if where is not None:
        target = target.where(where)
    target = target.select(F.struct(*_FIELDS).alias(end))
    steps = _steps(graph, type_, direction)
    block = steps.join(target, (F.col(f"{end}.universe") == F.col("universe")) & (F.col(f"{end}.id") == F.col("b_id")) & F.array_contains(F.col(f"{end}.labels"), F.col("b_label")))
    link = F.struct("type", "forward", "a_label", "a_id", "b_label", "b_id", "props")
    block = block.select(F.col("universe").alias("_u"), F.col("a_label").alias("_l"), F.col("a_id").alias("_i"), link.alias(edge or "_edge"), end)
    same = (F.col(f"{start}.universe") == F.col("_u")) & (F.col(f"{start}.id") == F.col("_i")) & (F.col(f"{start}.key_label") == F.col("_l"))
    found = rows.join(block, same, "left" if optional else "inner").drop("_u", "_l", "_i")
    return found if edge else found.drop("_edge")


def expand_keys(graph: Graph, rows: DataFrame, start: str, type_: str | None, end: str, *, direction: str = "out") -> DataFrame:
    """Like :func:`expand` without looking the end up: ``end`` has universe, key_label and id only."""
    steps = _steps(graph, type_, direction).select(F.col("universe").alias("_u"), F.col("a_label").alias("_l"), F.col("a_id").alias("_i"), F.struct("universe", F.col("b_label").alias("key_label"), F.col("b_id").alias("id")).alias(end))
    same = (F.col(f"{start}.universe") == F.col("_u")) & (F.col(f"{start}.id") == F.col("_i")) & (F.col(f"{start}.key_label") == F.col("_l"))
    return rows.join(steps, same).drop("_u", "_l", "_i")


def without(graph: Graph, rows: DataFrame, start: str, type_: str | None, *, direction: str = "out", end_label: str | None = None, end_id: str | None = None) -> DataFrame:
    """Rows whose ``start`` has no such edge: an anti join on the pattern."""
    steps = _steps(graph, type_, direction)
    if end_label:
        steps = steps.where(F.col("b_label") == end_label)
    if end_id:
        steps = steps.where(F.col("b_id") == end_id)
    same = (F.col(f"{start}.universe") == F.col("universe")) & (F.col(f"{start}.id") == F.col("a_id")) & (F.col(f"{start}.key_label") == F.col("a_label"))
    return rows.join(steps, same, "left_anti")


def without_match(rows: DataFrame, matches: DataFrame, variables: list[str]) -> DataFrame:
    """Rows for whose ``variables`` no row of ``matches``, a further pattern, exists."""
    keys = lambda of: [F.struct(*[F.col(f"{of}{v}.{f}") for f in ("universe", "key_label", "id")]) for v in variables]
    found = matches.select(*[k.alias(f"_m{n}") for n, k in enumerate(keys(""))]).distinct()
    same = [keys("")[n] == F.col(f"_m{n}") for n in range(len(variables))]
    return rows.join(found, same, "left_anti")


#: Nodes that :func:`pairs_apart` broadcasts at most, with their ids and what they must not share; more are joined by sorting.
SMALL = 200_000


def pairs_apart(graph: Graph, label: str, meet: tuple[str, str], apart: tuple[str, str], start: str, end: str, *, blocks: int | None = None, small: int = SMALL) -> DataFrame:
    """Pairs of different nodes with ``label`` that reach a common node by ``meet`` and none by ``apart``, each pair once in either order.

    ``meet`` and ``apart`` are (type, direction). ``start`` and ``end`` have
    universe, key_label and id, as the edges name them; nodes themselves aren't
    looked up. Edges without an end reach nothing, repeated ones count once.

    Two nodes may meet at many others, so paths outnumber pairs by far and
    never travel. Nodes are numbered in order of their ids and cut into
    ``blocks``. The sorted numbers of those that meet somewhere go once to each
    block that has one of them, from its first one on: there every pair whose
    lesser number is of that block is made and deduplicated, whatever it meets
    at. No list is longer than the pairs that it makes for each of its nodes.
    """
    spark = graph.edges.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = lambda of: _steps(graph, *of).where((F.col("a_label") == label) & F.col("a_id").isNotNull() & F.col("b_id").isNotNull()).select("universe", "a_id", "b_label", "b_id")
    near = steps(apart).groupBy("universe", "a_id").agg(F.collect_set(F.concat_ws("\x01", "b_label", "b_id")).alias("_near"))
    nodes = steps(meet).select("universe", "a_id").distinct().join(near, ["universe", "a_id"], "left")
    nodes = nodes.repartitionByRange(blocks, "universe", "a_id").sortWithinPartitions("universe", "a_id")
    # a number is its block, shifted by 33 bits, plus a place within it
    nodes = _kept(nodes.select("universe", "a_id", F.coalesce("_near", F.array().cast("array<string>")).alias("_near"), F.monotonically_increasing_id().alias("_n")))
    hint = F.broadcast if nodes.count() <= small else (lambda df: df)
    block = lambda n: F.shiftright(n, 33)
    at = steps(meet).join(hint(nodes.select("universe", "a_id", "_n")), ["universe", "a_id"]).select("universe", "b_label", "b_id", "_n")
    lists = at.repartition("universe", "b_label", "b_id").groupBy("universe", "b_label", "b_id").agg(F.array_sort(F.collect_set("_n")).alias("_all")).select("_all")
    sent = lists.where(F.size("_all") > 1).select("_all", F.explode(F.array_distinct(F.transform("_all", block))).alias("_block"))
    sent = sent.select("_block", F.filter("_all", lambda n: block(n) >= F.col("_block")).alias("_rest")).where(F.size("_rest") > 1)
    sent = sent.repartitionById(blocks, F.col("_block").cast("int"))
    pairs = sent.select("_block", "_rest", F.posexplode(F.filter("_rest", lambda n: block(n) == F.col("_block"))).alias("_at", "_a"))
    pairs = pairs.select("_block", "_a", F.explode(F.slice("_rest", F.col("_at") + 2, F.size("_rest"))).alias("_b")).distinct()
    side = lambda x: nodes.select(F.col("_n").alias(f"_{x}"), F.struct("universe", F.lit(label).alias("key_label"), F.col("a_id").alias("id")).alias(f"_node_{x}"), F.col("_near").alias(f"_near_{x}"))
    pairs = pairs.select("_a", "_b").join(hint(side("a")), "_a").join(hint(side("b")), "_b").where(~F.arrays_overlap("_near_a", "_near_b"))
    either = F.array(*[F.struct(F.col(f"_node_{x}").alias(start), F.col(f"_node_{y}").alias(end)) for x, y in ("ab", "ba")])
    return pairs.select(F.explode(either).alias("_pair")).select(f"_pair.{start}", f"_pair.{end}")


def without_greater(rows: DataFrame, group: str, value: Column) -> DataFrame:
    """Rows than which none of the same ``group`` has a greater value: the group's greatest decides for all of it, without pairs. A null value is neither greater nor less."""
    best = rows.groupBy(group).agg(F.max(value).alias("_best"))
    return rows.join(best, group).where((value >= F.col("_best")) | value.isNull() | F.col("_best").isNull()).drop("_best")


def degree(graph: Graph, type_: str | None, *, direction: str = "out", least: int = 1) -> DataFrame:
    """(universe, key_label, id, n) of nodes with at least ``least`` edges of a type."""
    steps = _steps(graph, type_, direction)
    return steps.groupBy("universe", F.col("a_label").alias("key_label"), F.col("a_id").alias("id")).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _kept(rows: DataFrame) -> DataFrame:
    """``rows`` computed once: as a checkpoint where the session has a folder for it, else in storage."""
    if rows.sparkSession.sparkContext.getCheckpointDir() or rows.sparkSession.conf.get("spark.checkpoint.dir", None):
        return rows.checkpoint()
    return rows.persist()


def reach(graph: Graph, rows: DataFrame, start: str, types: list[str], end: str, *, least: int = 1, most: int | None = None, direction: str = "out") -> DataFrame:
    """Variable-length expansion over trails: edges don't repeat within a path, nodes may.

    Adds ``end`` (universe, key_label, id), ``depth`` and ``path``, the ids on
    the way. Each frontier is kept, so that a step costs one join whatever came
    before it; a step without rows ends the loop. Trails end since their edges
    differ; ``most`` cuts them only where the pattern itself does.
    """
    steps = _steps(graph, None, direction).where(F.col("type").isin(types))
    steps = steps.select(F.col("universe").alias("_u"), F.col("a_label").alias("_al"), F.col("a_id").alias("_ai"), F.col("b_label").alias("_bl"), F.col("b_id").alias("_bi"), F.concat_ws("\x01", "type", F.when(F.col("forward"), F.concat_ws("\x02", "a_label", "a_id", "b_label", "b_id")).otherwise(F.concat_ws("\x02", "b_label", "b_id", "a_label", "a_id"))).alias("_e"))
    at = F.struct(F.col(f"{start}.universe").alias("universe"), F.col(f"{start}.key_label").alias("key_label"), F.col(f"{start}.id").alias("id"))
    frontier = rows.withColumn(end, at).withColumn("depth", F.lit(0)).withColumn("path", F.array(F.col(f"{start}.id"))).withColumn("_trail", F.array().cast("array<string>"))
    found = [frontier] if least == 0 else []
    for depth in count(1) if most is None else range(1, most + 1):
        here = (F.col(f"{end}.universe") == F.col("_u")) & (F.col(f"{end}.key_label") == F.col("_al")) & (F.col(f"{end}.id") == F.col("_ai"))
        frontier = frontier.join(steps, here).where(~F.array_contains("_trail", F.col("_e")))
        frontier = frontier.withColumn(end, F.struct(F.col("_u").alias("universe"), F.col("_bl").alias("key_label"), F.col("_bi").alias("id"))).withColumn("depth", F.lit(depth)).withColumn("path", F.concat("path", F.array("_bi"))).withColumn("_trail", F.concat("_trail", F.array("_e"))).drop("_u", "_al", "_ai", "_bl", "_bi", "_e")
        frontier = _kept(frontier)
        if frontier.isEmpty():
            break
        if depth >= least:
            found.append(frontier)
    found = found or [frontier]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.drop("_trail")


def top(rows: DataFrame, by: Column, tie: Column, n: int) -> DataFrame:
    """The first ``n`` rows in descending order, null being the largest value as in graph queries."""
    return rows.orderBy(by.desc_nulls_first(), tie.asc_nulls_last()).limit(n)
