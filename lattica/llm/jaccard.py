"""N-gram Jaccard join in the metric space of shingle sets.

One minus Jaccard similarity is a metric, but documents that share nothing all
lie at distance 1, and so would be equally far from nearly every document
chosen as a pivot: windows around such pivots replicate everything. The first
pivots are therefore single shingles. Under the size of the symmetric
difference, also a metric, a document is nearest to the pivots that it holds;
one order of all shingles breaks the ties, and its Voronoi region is that of
its least shingle. The triangle inequality bounds how many of a document's
least shingles a document within reach can lack, so replicating a document to
the regions of that many shingles (its window) lets every linked pair meet.

Members of a region of up to ``REGION`` documents are compared with each other.
A larger region takes documents as pivots: first the member with the fewest
rare shingles, then, turn by turn, such members of the components that are
still apart. A pivot's distance to the others is computed exactly; what it
links needs no comparing among itself. When turns no longer bring components
together, the rest is compared in blocks, in a window of distance to the first
pivot. Large regions of shingles that weren't known to be frequent are joined
recursively: their documents form a smaller collection, in which the order puts
those shingles last.

Exact throughout: filters (sizes, places in the order, parity sketches) only
reject what provably isn't linked, and each link is confirmed on whole texts.
Equal sets are one node. All tables stay distributed; only at most ``FREQUENT``
shingles that a share of the documents shows to be frequent are broadcast, and
they decide nothing but the order and how regions are spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.llm.common import join_by_hot, written
from lattica.llm.components import connected
from lattica.llm.shingles import mix, text_sets

#: Similarity, as a fraction.
NUMERATOR, DENOMINATOR = 75, 100
#: Documents of a region that are compared among themselves without pivots.
REGION = 64
#: A region of a shingle not known to be frequent is joined recursively from so many documents on.
STUCK = 512
#: At least so many documents, and one in SHARE, tell which shingles are frequent; how often they must show one; how many are kept at most.
SAMPLE, SHARE, SHOWN, FREQUENT = 8192, 32, 3, 1 << 20
#: Compared with one pivot in one task, and members of a block of a large region.
PER_TASK = 512
#: Recursions that reorder; what is still together afterwards is joined as it is.
LEVELS = 6
#: A turn gives each large region up to PIVOTS pivots. Turns go on while regions hold more than DENSE pairs an entry that are still apart and each turn halves them.
PIVOTS, DENSE = 8, 4
#: Rows of two numbers that may be broadcast.
BROADCAST_ROWS = 1_000_000

_NONE = np.zeros(0, np.uint64)


def set_key(own: np.ndarray) -> int:
    """A 64-bit hash of a set of shingles."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([own.sum() * np.uint64(3) + np.bitwise_xor.reduce(mix(own)) + np.uint64(len(own))], np.uint64)).view(np.int64)[0])


def window_size(n: int) -> int:
    """How many least shingles of a set of ``n`` can a linked set lack all but one of."""
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def parity_sketch(own: np.ndarray) -> bytes:
    """One bit for each residue of the hashes: whether an odd number has it. Two sketches differ in no more bits than the sets in shingles."""
    bits = 64
    while bits < len(own):
        bits *= 2
    odd = np.bincount((own >> np.uint64(20) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def fold(own: np.ndarray) -> list[int]:
    """A parity sketch of 256 bits as four numbers, for expressions."""
    odd = np.bincount((own >> np.uint64(20) & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def sketches_differ(a: bytes, b: bytes) -> int:
    """Bits that differ, the longer sketch folded to the length of the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _ordered(own: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """A sorted set in the order of the level: frequent shingles last."""
    if not len(frequent):
        return own
    late = np.isin(own, frequent, assume_unique=True)
    return np.concatenate([own[~late], own[late]])


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what is made of one stays small."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


_FOLD = ["f0", "f1", "f2", "f3"]
_NODES = "doc_id long, node long, n int, least binary, sketch binary, f0 long, f1 long, f2 long, f3 long"
_NODE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("least", pa.binary()), ("sketch", pa.binary()), *[(f, pa.int64()) for f in _FOLD]])


def _nodes(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each text its set's key and size, and, where the task meets the key for the first time, window and sketch."""
    met: set[int] = set()
    for batch in _slices(batches):
        keys, sizes, least, sketch, folds = [], [], [], [], []
        for own, doc_id in zip(text_sets(batch.column(1)), batch.column(0).to_pylist(), strict=True):
            key = set_key(own) if len(own) else None
            keys.append(key)
            sizes.append(len(own))
            new = key is not None and doc_id is not None and key not in met
            if new:
                met.add(key)
            least.append(_ordered(own, frequent)[: window_size(len(own))].tobytes() if new else None)
            sketch.append(parity_sketch(own) if new else None)
            folds.append(fold(own) if new else [None] * 4)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), pa.array(least, pa.binary()), pa.array(sketch, pa.binary()), *[pa.array([x[k] for x in folds], pa.int64()) for k in range(4)]], schema=_NODE_SCHEMA)


_ENTRY = np.dtype([("shingle", np.uint64), ("node", np.int64), ("n", np.int32), ("place", np.int32)])
_PART_SCHEMA = pa.schema([("part", pa.int32()), ("entries", pa.binary())])


def _deal(batches: Iterator[pa.RecordBatch], parts: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Windows cut into entries, packed by the part that their shingle belongs to; those of a frequent one are spread over all parts."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            few = batch.slice(at, 512)
            windows = [np.frombuffer(x, np.uint64) for x in few.column(2).to_pylist()]
            lengths = [len(x) for x in windows]
            out = np.empty(sum(lengths), _ENTRY)
            out["shingle"] = np.concatenate(windows) if windows else _NONE
            out["node"] = np.repeat(few.column(0).to_numpy(zero_copy_only=False), lengths)
            out["n"] = np.repeat(few.column(1).to_numpy(zero_copy_only=False), lengths)
            out["place"] = np.concatenate([np.arange(x) for x in lengths]) if lengths else 0
            spread = np.where(np.isin(out["shingle"], frequent), mix(np.ascontiguousarray(out["node"]).view(np.uint64)), np.uint64(0))
            part = (mix(out["shingle"] ^ spread) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            out, part = out[order], part[order]
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, int)
            yield pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]], pa.int32()), pa.array([out[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], schema=_PART_SCHEMA)


#: Rows are entries of large regions (``members`` is 0 for a frequent shingle's) or, where ``other`` is given, pairs of members of small ones.
_FOUND = "shingle long, node long, n int, place int, members int, other long"
_FOUND_SCHEMA = pa.schema([("shingle", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("place", pa.int32()), ("members", pa.int32()), ("other", pa.int64())])


def _gather(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What regions of two members or more hold; parts come one after the other."""
    held: list[bytes] = []
    current = None
    for batch in batches:
        for part, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if part != current:
                yield from _regions(held, frequent)
                held, current = [], part
            held.append(entries)
    yield from _regions(held, frequent)


def _regions(held: list[bytes], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    e = np.frombuffer(b"".join(held), _ENTRY)
    held.clear()
    late = np.isin(e["shingle"], frequent)
    order = np.argsort(e["shingle"], kind="stable")
    shingle = e["shingle"][order]
    same = np.zeros(len(e), bool)
    same[1:] = shingle[1:] == shingle[:-1]
    many = same | late[order]
    many[:-1] |= same[1:]
    e = e[order[many]]
    e = e[np.lexsort((e["node"], e["shingle"]))]
    if not len(e):
        return
    e = e[np.r_[True, (e["shingle"][1:] != e["shingle"][:-1]) | (e["node"][1:] != e["node"][:-1])]]
    starts = np.flatnonzero(np.r_[True, e["shingle"][1:] != e["shingle"][:-1]])
    sizes = np.diff(np.r_[starts, len(e)])
    late = np.isin(e["shingle"][starts], frequent)
    few = ~late & (sizes > 1) & (sizes <= REGION)
    pairs = [_NO_PAIRS]
    for m in np.unique(sizes[few]):
        of_size = starts[few & (sizes == m)]
        step = max(1, (1 << 20) // int(m * m))
        for at in range(0, len(of_size), step):
            pairs.append(_member_pairs(e, of_size[at : at + step], int(m)))
    pairs = np.unique(np.concatenate(pairs))
    for at in range(0, len(pairs), 65536):
        x = pairs[at : at + 65536]
        none = pa.nulls(len(x), pa.int64()), pa.nulls(len(x), pa.int32())
        yield pa.RecordBatch.from_arrays([none[0], pa.array(np.ascontiguousarray(x["a"])), none[1], none[1], none[1], pa.array(np.ascontiguousarray(x["b"]))], schema=_FOUND_SCHEMA)
    large = np.repeat(late | (sizes > REGION), sizes)
    members = np.repeat(np.where(late, 0, sizes), sizes)[large].astype(np.int32)
    e = e[large]
    for at in range(0, len(e), 65536):
        x = e[at : at + 65536]
        columns = [x["shingle"].view(np.int64), x["node"], x["n"], x["place"], members[at : at + 65536]]
        yield pa.RecordBatch.from_arrays([*[pa.array(np.ascontiguousarray(c)) for c in columns], pa.nulls(len(x), pa.int64())], schema=_FOUND_SCHEMA)


_PAIR = np.dtype([("a", np.int64), ("b", np.int64)])
_NO_PAIRS = np.zeros(0, _PAIR)


def _as_pairs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), _PAIR)
    out["a"], out["b"] = np.minimum(x, y), np.maximum(x, y)
    return out


def _member_pairs(e: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    """Pairs of members, of regions of ``m`` entries each, that sizes and places don't rule out."""
    i, j = np.triu_indices(m, 1)
    x, y = e[(starts[:, None] + i).ravel()], e[(starts[:, None] + j).ravel()]
    fits = _may_link(x["n"].astype(np.int64), x["place"], y["n"].astype(np.int64), y["place"])
    return np.unique(_as_pairs(x["node"][fits], y["node"][fits]))


def _may_link(n: np.ndarray, place: np.ndarray, other_n: np.ndarray, other_place: np.ndarray) -> np.ndarray:
    """As :func:`_could_link`, of arrays."""
    fits = DENOMINATOR * np.minimum(n, other_n) >= NUMERATOR * np.maximum(n, other_n)
    return fits & ((NUMERATOR + DENOMINATOR) * np.minimum(n - place, other_n - other_place) >= NUMERATOR * (n + other_n))


def _frequent(docs: DataFrame, count: int) -> np.ndarray:
    """At most FREQUENT shingles that a share of ``docs`` (doc_id, text) shows to be frequent, sorted."""
    share = min(1.0, max(SAMPLE / max(1, count), 1 / SHARE))
    least = max(SHOWN, int(REGION * share))
    sample = docs if share == 1 else docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    parts = max(32, int(count * share) // 2048)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 2048):
            sets = text_sets(batch.column(1))
            own = np.concatenate(sets) if sets else _NONE
            part = (mix(own) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            own, part = own[order], part[order]
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, int)
            yield pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]], pa.int32()), pa.array([own[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], schema=_PART_SCHEMA)

    def count_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for part, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(part, []).append(entries)
        for part, entries in held.items():
            values, counts = np.unique(np.frombuffer(b"".join(entries), np.uint64), return_counts=True)
            shown = counts >= least
            values, counts = values[shown], counts[shown]
            most = np.argsort(-counts, kind="stable")[: -(-FREQUENT // parts)]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([values[most].tobytes()], pa.binary())], schema=_PART_SCHEMA)

    counted = sample.mapInArrow(cut, "part int, entries binary").repartition(parts, "part").mapInArrow(count_, "part int, entries binary")
    found = [np.frombuffer(bytes(r.entries), np.uint64) for r in counted.collect()]
    return np.sort(np.concatenate(found)) if found else _NONE


def _could_link(n: str, place: str, other_n: str, other_place: str) -> str:
    """SQL: neither the sizes nor the places of the first shared shingle rule out a link.

    A linked pair meets in the region of its first shared shingle, too, and
    all that it shares lies from there on.
    """
    total = NUMERATOR + DENOMINATOR
    return (
        f"{DENOMINATOR}L * least({n}, {other_n}) >= {NUMERATOR}L * greatest({n}, {other_n})"
        f" and {total}L * least({n} - {place}, {other_n} - {other_place}) >= {NUMERATOR}L * ({n} + {other_n})"
    )


def _near(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Of (a, b) pairs those whose sketches don't rule out a link."""
    left = sketches.select(F.col("node").alias("a"), F.col("n").alias("an"), F.col("sketch").alias("x"))
    right = sketches.select(F.col("node").alias("b"), F.col("n").alias("bn"), F.col("sketch").alias("y"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            an, x, bn, y = (batch.column(k).to_pylist() for k in (2, 3, 4, 5))
            total = NUMERATOR + DENOMINATOR
            fits = [total * sketches_differ(x[i], y[i]) <= (DENOMINATOR - NUMERATOR) * (an[i] + bn[i]) for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(fits, pa.bool_()))

    return _small(pairs).join(left, "a").join(right, "b").select("a", "b", "an", "x", "bn", "y").mapInArrow(keep, "a long, b long")


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, shared, a_n, b_n) of the pairs, from the whole ``texts`` (node, text). A pivot's pairs are dealt to as many tasks as they need."""
    degrees = written(pairs.groupBy("a").agg(F.count("*").alias("_degree")).where(F.col("_degree") > PER_TASK), "jaccard-degrees")
    dealt = pairs.join(_small(degrees), "a", "left").withColumn("_deal", F.pmod(F.xxhash64("b"), F.coalesce(F.ceil(F.col("_degree") / PER_TASK), F.lit(1))).cast("int")).drop("_degree")
    pivots = dealt.select("a", "_deal").distinct().join(texts.withColumnRenamed("node", "a"), "a").select("a", "_deal", F.lit(0).alias("role"), F.col("a").alias("b"), "text")
    others = dealt.join(texts.withColumnRenamed("node", "b"), "b").select("a", "_deal", F.lit(1).alias("role"), "b", "text")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int32()), ("a_n", pa.int32()), ("b_n", pa.int32())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = _NONE
        for batch in _slices(batches):
            rows = []
            a, role, b = (batch.column(k).to_pylist() for k in (0, 2, 3))
            for i, own in enumerate(text_sets(batch.column(4))):
                if not len(own) or set_key(own) != (b[i] if role[i] else a[i]):
                    continue  # another text under the same id
                if role[i] == 0:
                    pivot = own
                else:
                    rows.append((a[i], b[i], len(np.intersect1d(pivot, own, assume_unique=True)), len(pivot), len(own)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 5, schema.types, strict=True)], schema=schema)

    both = pivots.unionByName(others).repartition("a", "_deal").sortWithinPartitions("a", "_deal", "role")
    return both.mapInArrow(compare, "a long, b long, shared int, a_n int, b_n int")


_LINKED = f"{DENOMINATOR}L * shared >= {NUMERATOR}L * (a_n + b_n - shared)"


def _small(df: DataFrame) -> DataFrame:
    """``df``, a written table, marked for broadcast if it is small enough; if not, joins shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _links(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, reps: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The links among candidate pairs, and all pairs that were compared on texts, with what they share."""
    near = written(_near(written(pairs, f"{name}-pairs"), sketches), f"{name}-near")
    needed = near.select(F.col("a").alias("node")).union(near.select("b")).distinct().join(reps.select("node", F.col("doc_id").alias("_id")), "node")
    needed = _small(written(needed, f"{name}-needed"))
    texts = docs.select(F.col("doc_id").alias("_id"), "text").join(needed, "_id").select("node", "text")
    compared = written(_confirm(near, texts), f"{name}-compared")
    return compared.where(_LINKED).select("a", "b"), compared


def _apart(entries: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """Entries, with the labels of their nodes, of regions whose members have several labels."""
    labels = _small(written(labels, f"{name}-by"))
    labelled = entries.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = labelled.groupBy("shingle").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo <> _hi").select("shingle")
    return written(labelled.join(_small(written(several, f"{name}-of")), "shingle"), name)


def _crossing(entries: DataFrame) -> tuple[int, int]:
    """Pairs of members of one region with different labels, and entries, over all regions."""
    counts = entries.groupBy("shingle", "label").agg(F.count("*").alias("n")).groupBy("shingle").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("s"))
    row = counts.agg(F.coalesce(F.sum((F.col("n") * F.col("n") - F.col("s")) / 2), F.lit(0.0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return int(row[0]), int(row[1])


#: The fewest rare shingles before a frequent one, then the most shingles: the order that finds a region's most central member.
_CENTRAL = "struct(place, -n as negative, node)"


def _with_pivot(entries: DataFrame, name: str) -> DataFrame:
    """Entries with their region's first pivot."""
    pivots = entries.groupBy("shingle").agg(F.min(F.expr(_CENTRAL)).alias("_p"))
    pivots = written(pivots.select("shingle", F.col("_p.node").alias("pivot"), (-F.col("_p.negative")).alias("pivot_n"), F.col("_p.place").alias("pivot_place")), name)
    return entries.join(_small(pivots), "shingle")


def _pivot_pairs(entries: DataFrame, name: str) -> DataFrame:
    """Pairs of each region's further pivots, central members of its PIVOTS largest components, with all members of other components."""
    heads = entries.groupBy("shingle", "label").agg(F.count("*").alias("_n"), F.min(F.expr(_CENTRAL)).alias("_head"))
    rank = F.row_number().over(Window.partitionBy("shingle").orderBy(F.desc("_n"), "_head", "label"))
    heads = heads.withColumn("_rank", rank).where(F.col("_rank") <= PIVOTS)
    heads = heads.select("shingle", F.col("label").alias("_label"), F.col("_head.node").alias("a"), (-F.col("_head.negative")).alias("an"), F.col("_head.place").alias("ap"))
    pairs = entries.join(_small(written(heads, name)), "shingle").where("label <> _label").where(_could_link("n", "place", "an", "ap"))
    return pairs.select("a", F.col("node").alias("b")).distinct()


_KEYS = ["shingle", "lo", "hi"]
_MEMBER = [*_KEYS, "block", "node", "n", "place", "label", "far", *_FOLD]


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of members of one region, or of two blocks of one, with different labels, that no filter rejects. Rows come by key."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    found: list[np.ndarray] = []
    size = 0
    rest: pa.Table | None = None

    def flush() -> pa.RecordBatch:
        pairs = np.unique(np.concatenate([_NO_PAIRS, *found]))
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs["a"])), pa.array(np.ascontiguousarray(pairs["b"]))], schema=schema)

    def groups() -> Iterator[dict[str, np.ndarray]]:
        nonlocal rest
        for batch in chain(batches, [None]):
            table = pa.Table.from_batches([batch]) if batch is not None else None
            if rest is not None:
                table = pa.concat_tables([rest, table]) if table is not None else rest
            if table is None or not table.num_rows:
                continue
            x = {c: table.column(c).to_numpy() for c in _MEMBER}
            change = np.zeros(table.num_rows, bool)
            for k in _KEYS:
                change[1:] |= x[k][1:] != x[k][:-1]
            cuts = np.r_[0, np.flatnonzero(change), table.num_rows]
            rest = None if batch is None else table.slice(int(cuts[-2]))
            for a, b in zip(cuts[: -1 if batch is None else -2], cuts[1:], strict=False):
                yield {c: v[a:b] for c, v in x.items()}

    for g in groups():
        own = g["block"] == g["lo"][0]
        one = g["lo"][0] == g["hi"][0]
        left = {c: v[own] for c, v in g.items()}
        right = left if one else {c: v[~own] for c, v in g.items()}
        n, m = left["n"].astype(np.int64)[:, None], right["n"].astype(np.int64)[None, :]
        fits = (left["label"][:, None] != right["label"][None, :]) & _may_link(n, left["place"][:, None], m, right["place"][None, :])
        # distances to the region's first pivot, where texts were compared, bound those between members
        fits &= ~(np.abs(left["far"][:, None] - right["far"][None, :]) > 1 - NUMERATOR / DENOMINATOR + 1e-9)
        if one:
            fits &= np.tri(len(n), k=-1, dtype=bool)
        i, j = np.nonzero(fits)
        differ = sum(np.bitwise_count((left[f][i] ^ right[f][j]).view(np.uint64)).astype(np.int64) for f in _FOLD)
        near = (NUMERATOR + DENOMINATOR) * differ <= (DENOMINATOR - NUMERATOR) * (left["n"][i].astype(np.int64) + right["n"][j])
        found.append(_as_pairs(left["node"][i[near]], right["node"][j[near]]))
        size += int(near.sum())
        if size > 1 << 18:
            yield flush()
            size = 0
    yield flush()


def _members(entries: DataFrame, far: DataFrame, sketches: DataFrame, name: str) -> DataFrame:
    """Candidate pairs among all members of the regions in ``entries``; a large region is cut into blocks, and two blocks at a time meet in a task."""
    blocks = written(entries.groupBy("shingle").agg(F.ceil(F.count("*") / PER_TASK).cast("int").alias("_blocks")), f"{name}-blocks")
    x = entries.join(_small(blocks), "shingle").join(_small(far), ["pivot", "node"], "left")
    x = _small(written(x.select("shingle", "node", "n", "place", "label", F.coalesce("far", F.lit(float("nan"))).alias("far"), "_blocks"), f"{name}-entries"))
    x = x.join(sketches.select("node", *_FOLD), "node")
    x = x.withColumn("block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    x = x.withColumn("lo", F.least("block", "_other")).withColumn("hi", F.greatest("block", "_other"))
    dealt = x.select(*_MEMBER).repartition(*_KEYS).sortWithinPartitions(*_KEYS)
    return dealt.mapInArrow(_block_pairs, "a long, b long").distinct()


def _level(docs: DataFrame, nodes: DataFrame, sketches: DataFrame, reps: DataFrame, frequent: np.ndarray, links: DataFrame | None, last: bool, name: str) -> tuple[DataFrame, DataFrame]:
    """``links`` and what connects the level's nodes, but for pairs that only meet in regions put off; and the nodes of those regions.

    A region of STUCK documents or more of a shingle that isn't known to be
    frequent is put off, but for the last level.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) * 4
    known = spark.sparkContext.broadcast(frequent)
    entries = nodes.where("least is not null").select("node", "n", "least").mapInArrow(lambda b: _deal(b, parts, known.value), "part int, entries binary")
    found = written(entries.repartition(max(1, parts // 4), "part").sortWithinPartitions("part").mapInArrow(lambda b: _gather(b, known.value), _FOUND), f"{name}-regions")
    large = written(_with_pivot(found.where("other is null").drop("other"), f"{name}-pivots"), f"{name}-large")
    to_pivot = large.where("node <> pivot").where(_could_link("n", "place", "pivot_n", "pivot_place"))
    pairs = found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")).union(to_pivot.select("pivot", "node")).distinct()
    more, compared = _links(pairs, sketches, docs, reps, f"{name}-first")
    links = more if links is None else links.unionByName(more)
    open_ = _apart(large, connected(links, f"{name}-labels"), f"{name}-open")
    put_off = (F.col("members") >= STUCK) & F.lit(not last)
    stuck = open_.where(put_off).select("node").distinct()
    open_ = open_.where(~put_off)
    turn, before = 0, None
    while True:
        apart, size = _crossing(open_)
        if apart <= DENSE * size or (before is not None and 2 * apart > before):
            break
        more, further = _links(_pivot_pairs(open_, f"{name}-turn-{turn}-heads"), sketches, docs, reps, f"{name}-turn-{turn}")
        links, compared = links.unionByName(more), compared.unionByName(further)
        open_ = _apart(open_, connected(links, f"{name}-turn-{turn}-labels"), f"{name}-turn-{turn}-open")
        turn, before = turn + 1, apart
    if size:
        far = compared.select(F.col("a").alias("pivot"), F.col("b").alias("node"), (1 - F.col("shared") / (F.col("a_n") + F.col("b_n") - F.col("shared"))).alias("far")).groupBy("pivot", "node").agg(F.min("far").alias("far"))
        more, _ = _links(_members(open_, written(far, f"{name}-far"), sketches, name), sketches, docs, reps, f"{name}-members")
        links = links.unionByName(more)
    return written(links, f"{name}-links"), stuck


def _components(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: (doc_id, n, node, part, component_id), where ``part`` tells components of the same least id apart; null without shingles."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    frequent = _frequent(docs, docs.count())
    shared = spark.sparkContext.broadcast(frequent)
    nodes = written(docs.mapInArrow(lambda b: _nodes(b, shared.value), _NODES), "jaccard-nodes")
    reps = written(nodes.where("node is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "jaccard-reps")
    sketches = written(nodes.where("sketch is not null").groupBy("node").agg(F.max("n").alias("n"), F.max("sketch").alias("sketch"), *[F.max(f).alias(f) for f in _FOLD]), "jaccard-sketches")
    links, stuck = _level(docs, nodes, sketches, reps, frequent, None, False, "jaccard-0")
    for level in range(1, LEVELS + 1):
        ids = written(stuck.join(reps, "node").select("doc_id").distinct(), f"jaccard-{level}-stuck")
        count = ids.count()
        if not count:
            break
        ids = _small(ids)
        part = written(docs.join(ids, "doc_id", "left_semi"), f"jaccard-{level}-docs")
        frequent = np.union1d(frequent, _frequent(part, count))
        own = spark.sparkContext.broadcast(frequent)
        below = written(part.mapInArrow(lambda b, own=own: _nodes(b, own.value), _NODES), f"jaccard-{level}-nodes")
        links, stuck = _level(part, below, sketches, reps, frequent, links, level == LEVELS, f"jaccard-{level}")
    labels = written(connected(links, "jaccard-labels"), "jaccard-labelled")
    components = written(labels.join(reps, "node").groupBy("label").agg(F.min("doc_id").alias("least")), "jaccard-least")
    labels = join_by_hot(labels, components, "label")
    of_node = written(reps.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("part"), F.coalesce("least", "doc_id").alias("least")), "jaccard-parts")
    rows = join_by_hot(nodes.select("doc_id", "n", "node"), of_node, "node")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return rows.select("doc_id", "n", "node", "part", component.alias("component_id"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_shingles, component_id).

    Links join rows whose shingle sets have a similarity of 0.75 or more;
    ``component_id`` is the least doc_id that links reach. Null and empty
    texts, and texts without words, have no shingles and no links: their
    component is their own id. A row without an id links nothing, and its
    component is null. Rows that repeat an id with different texts link each by
    their own text. An empty table gives an empty table. Only doc_id and text are read.
    """
    return _components(docs).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


@F.arrow_udf(T.LongType())
def _set_keys(texts: pa.Array) -> pa.Array:
    return pa.array([set_key(own) if len(own) else None for own in text_sets(texts)], pa.int64())


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, of its least id, and all rows without an id.

    Rows that repeat an id are told apart by their shingle sets: of those with
    one set, or without shingles, one stays, that of the least text; those in
    different components stay each. Null and empty texts have no shingles, are
    near copies of nothing and stay. An empty table gives an empty table.
    Columns are those of ``docs``, whatever their names.
    """
    rows = written(_components(docs).where("doc_id is not null"), "jaccard-rows")
    ids = rows.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max(F.col("doc_id") == F.col("component_id")).alias("least"))
    # columns take plain names of their own; both ways below read the same ones, so that texts travel once
    own = [f"c{k}" for k in range(len(docs.columns))]
    id_, text = (own[docs.columns.index(c)] for c in ("doc_id", "text"))
    named = docs.toDF(*own).withColumn("doc_id", F.col(id_).cast("long"))
    of_least = named.join(ids.where("least"), "doc_id")
    once = of_least.where("rows = 1").select(*own)
    kept = rows.where("doc_id = component_id").groupBy("doc_id", "part").agg(F.min("node").alias("kept")).drop("part")
    repeated = of_least.where("rows > 1").withColumn("key", _set_keys(F.col(text)))
    chosen = repeated.join(kept, (repeated["doc_id"] == kept["doc_id"]) & repeated["key"].eqNullSafe(kept["kept"]), "left_semi")
    first = F.row_number().over(Window.partitionBy("doc_id", "key").orderBy(text))
    repeated = chosen.withColumn("nth", first).where("nth = 1").select(*own)
    once, repeated = once.toDF(*docs.columns), repeated.toDF(*docs.columns)
    return once.unionByName(repeated).unionByName(docs.where("doc_id is null"))
