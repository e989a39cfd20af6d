"""Resharding that moves the fewest bytes, by minimum-cost flow.

Rows lie in old shards, each cut into blocks by a hash of the id. Only the
blocks' sizes, a table of a fixed number of rows, reach the driver. A flow from
old shards to new ones, with the new shards' capacities, where staying costs
nothing and a moved byte costs one, says how many bytes go where; blocks then
fill the flow, largest first. Rows get their shard from their block, and their
slot from where their block starts in the shard plus their number within the
block, so no shard is ever brought together in one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.llm.common import discard, hash_bucket, written

OLD_SHARDS = 16
NEW_SHARDS = 24
BLOCKS = 512
PER_ROW = 8


def min_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost: Callable[[int, int], int]) -> dict[tuple[int, int], int]:
    """Amounts (old, new) -> units that ship all ``supply`` within ``capacity`` at the least cost.

    Successive shortest paths with potentials. ``cost`` is per unit and not
    negative. Raises ValueError if the capacities are too small.
    """
    olds, news = len(supply), len(capacity)
    source, sink = olds + news, olds + news + 1
    edges: list[list[int]] = []  # to, room, cost
    out: list[list[int]] = [[] for _ in range(olds + news + 2)]

    def add(a: int, b: int, room: int, price: int) -> None:
        for x, y, r, p in ((a, b, room, price), (b, a, 0, -price)):
            out[x].append(len(edges))
            edges.append([y, r, p])

    pairs = {}
    for o, amount in enumerate(supply):
        add(source, o, amount, 0)
        for s in range(news):
            pairs[o, s] = len(edges)
            add(o, olds + s, amount, cost(o, s))
    for s, room in enumerate(capacity):
        add(olds + s, sink, room, 0)
    potential = [0] * len(out)
    left = sum(supply)
    while left > 0:
        far = [float("inf")] * len(out)
        by = [-1] * len(out)
        far[source] = 0
        heap = [(0, source)]
        while heap:
            d, x = heapq.heappop(heap)
            if d > far[x]:
                continue
            for k in out[x]:
                y, room, price = edges[k]
                e = d + price + potential[x] - potential[y]
                if room and e < far[y]:
                    far[y], by[y] = e, k
                    heapq.heappush(heap, (e, y))
        if by[sink] < 0:
            raise ValueError("the new shards' capacities are smaller than the old shards' sizes")
        potential = [p + (f if f < float("inf") else 0) for p, f in zip(potential, far, strict=True)]
        path, at = [], sink
        while at != source:
            path.append(by[at])
            at = edges[by[at] ^ 1][0]
        amount = min(left, *(edges[k][1] for k in path))
        for k in path:
            edges[k][1] -= amount
            edges[k ^ 1][1] += amount
        left -= amount
    return {pair: edges[k ^ 1][1] for pair, k in pairs.items() if edges[k ^ 1][1]}


@dataclass(frozen=True)
class Block:
    old: int
    block: int
    size: int
    rows: int


def assign_blocks(blocks: Sequence[Block], n_new: int) -> dict[tuple[int, int], int]:
    """(old, block) -> new shard.

    New capacities are equal shares of all bytes. Blocks of an old shard fill
    its flows, largest first, each into the flow with the most room; old shards
    with the most to give come first, and what a flow lacks or has too much is
    made up by the shard's own fill, so that sizes stay near equal.
    """
    total = sum(b.size for b in blocks)
    olds = max((b.old for b in blocks), default=-1) + 1
    supply = [0] * olds
    for b in blocks:
        supply[b.old] += b.size
    room = [total // n_new + (s < total % n_new) for s in range(n_new)]
    flow = min_cost_flow(supply, room, lambda o, s: int(o != s))
    open_to = {o: {s: f for (x, s), f in flow.items() if x == o} for o in range(olds)}
    placed = {}
    for b in sorted(blocks, key=lambda b: (-b.size, b.old, b.block)):
        flows = open_to[b.old]
        most = max(flows, key=lambda s: (min(flows[s], room[s]), s == b.old, -s), default=b.old % n_new)
        if b.size and min(flows.get(most, 0), room[most]) < b.size // 2:
            most = max(range(n_new), key=lambda s: (room[s], s == b.old, -s))
        placed[b.old, b.block] = most
        if most in flows:
            flows[most] -= b.size
        room[most] -= b.size
    return placed


@dataclass(frozen=True)
class Placement:
    """Where blocks go: (old shard, block) -> new shard, and the slot that the block's rows start at."""

    shards: dict[tuple[int, int], int]
    starts: dict[tuple[int, int], int]
    n_new: int

    def table(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([T.StructField("old_shard", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("start", T.LongType())])
        return F.broadcast(spark.createDataFrame([(*key, s, self.starts[key]) for key, s in self.shards.items()], schema))  # a row for each block, a number that parameters fix

    def affected(self) -> set[int]:
        """Shards that gain or lose a block."""
        return {s for (old, _), new in self.shards.items() if old != new for s in (old, new)}

    def emptied(self) -> set[int]:
        """Shards that lose all they had."""
        return {old for old, _ in self.shards} - set(self.shards.values())


def _place(blocks: DataFrame, n_new: int) -> Placement:
    """The placement of blocks, from (old_shard, block, size, n) rows, one for each block."""
    found = sorted((Block(r.old_shard, r.block, r["size"], r.n) for r in blocks.collect()), key=lambda b: (b.old, b.block))
    placed = assign_blocks(found, n_new)
    starts, at = {}, [0] * n_new
    for b in found:
        s = placed[b.old, b.block]
        starts[b.old, b.block] = at[s]
        at[s] += b.rows
    return Placement(placed, starts, n_new)


def _blocked(docs: DataFrame, old_shard: Column | None, n_old: int, blocks: int, id_column: str) -> list[Column]:
    """Columns doc_id, size, text_crc32, old_shard and block of ``docs``."""
    text, key = F.col("text"), F.col(id_column)
    old = hash_bucket(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("/old")), n_old) if old_shard is None else old_shard.cast("int")
    spread = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("/"), F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("string"))
    return [
        key.alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + PER_ROW).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        old.alias("old_shard"),
        hash_bucket(spread, blocks).alias("block"),
    ]


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("old_shard", "block").agg(F.sum("size").alias("size"), F.count("*").alias("n"))


def reshard_plan(docs: DataFrame, *, old_shard: Column | None = None, n_old: int = OLD_SHARDS, n_new: int = NEW_SHARDS, blocks: int = BLOCKS, id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: (doc_id, size, text_crc32, old_shard, shard, slot).

    Size is the text's UTF-8 bytes, none for null, plus 8. ``old_shard`` says
    where rows lie now, from 0 to ``n_old`` - 1; unless given, it is the hash
    of the id. Null ids count as one empty id; repeated rows are rows of their
    own; an empty table gives an empty table; other columns are not read. At
    most ``n_old`` times ``blocks`` rows reach the driver.
    """
    rows = written(docs.select(*_blocked(docs, old_shard, n_old, blocks, id_column)), "shard-rows")
    table = _place(_sizes(rows), n_new).table(docs.sparkSession)
    nth = F.row_number().over(Window.partitionBy("old_shard", "block").orderBy("doc_id", "size", "text_crc32"))
    return rows.withColumn("nth", nth).join(table, ["old_shard", "block"]).select("doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("start") + F.col("nth") - 1).alias("slot"))


def reshard(docs: DataFrame, *, old_shard: Column | None = None, n_old: int = OLD_SHARDS, n_new: int = NEW_SHARDS, blocks: int = BLOCKS, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with size, text_crc32, old_shard, shard and slot as :func:`reshard_plan` gives them.

    Rows travel once, to be numbered within their block. Columns of ``docs``
    of these names are replaced; nulls, repeated rows and empty tables are as
    in the plan.
    """
    added = ["size", "text_crc32", "old_shard", "shard", "slot"]
    keys = docs.select(*_blocked(docs, old_shard, n_old, blocks, id_column))
    table = _place(_sizes(keys), n_new).table(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added]).alias("row")
    rows = docs.select(row, *_blocked(docs, old_shard, n_old, blocks, id_column))
    nth = F.row_number().over(Window.partitionBy("old_shard", "block").orderBy("doc_id", "size", "text_crc32"))
    return rows.withColumn("nth", nth).join(table, ["old_shard", "block"]).select("row.*", "size", "text_crc32", "old_shard", "shard", (F.col("start") + F.col("nth") - 1).alias("slot"))


def affected_shards(plan: DataFrame) -> DataFrame:
    """Shards whose files change: (shard, bytes_in, rows_in), from rows that come from elsewhere.

    An empty plan, or one that moves nothing, gives no rows.
    """
    moved = plan.where("shard <> old_shard")
    gained = moved.select("shard", "size", F.lit(1).alias("n"))
    lost = moved.select(F.col("old_shard").alias("shard"), F.lit(0).cast("long").alias("size"), F.lit(0).alias("n"))
    return gained.unionByName(lost).groupBy("shard").agg(F.sum("size").alias("bytes_in"), F.sum("n").cast("long").alias("rows_in"))


def rewrite_shards(docs: DataFrame, path: str, *, old_shard: Column | None = None, n_old: int = OLD_SHARDS, n_new: int = NEW_SHARDS, blocks: int = BLOCKS, id_column: str = "doc_id") -> list[int]:
    """Writes the files of the affected shards, one folder ``shard=N`` each, and leaves all others as they are; returns their numbers.

    Every row goes where its block goes, so rows without an id and rows that
    repeat one keep their number. Folders of shards that lose all their rows
    are removed. A column ``shard`` of ``docs`` gives way to the folders'
    number. An empty table, or one that moves nothing, writes nothing. ``docs``
    must not read the files that are replaced.
    """
    spark = docs.sparkSession
    placement = _place(_sizes(docs.select(*_blocked(docs, old_shard, n_old, blocks, id_column))), n_new)
    affected = placement.affected()
    if not affected:
        return []
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "shard"]).alias("row")
    rows = docs.select(row, *_blocked(docs, old_shard, n_old, blocks, id_column)).join(placement.table(spark), ["old_shard", "block"])
    rows = rows.where(F.col("shard").isin(*affected)).repartition("shard", "block").select("row.*", "shard")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    for s in placement.emptied():
        discard(spark, f"{path}/shard={s}")
    return sorted(affected)
