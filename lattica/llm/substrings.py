"""Removal of repeated passages by suffix sorting.

A byte goes if a string of LENGTH bytes covers it that also starts earlier, in
a document of smaller id or further up in the same one.

Strings are first dealt out by content: each has GRAMS overlapping sequences of
GRAM bytes, and the least of their hashes is its key, so equal strings have
equal keys, and strings that follow one another mostly share theirs. Such a
stretch of starts is a segment. Keys that occur only once are done.
Segments of other keys meet in the part that the key belongs to, where their
text becomes one array, a two-stage suffix sort (:mod:`lattica.llm.suffixes`)
orders the strings, and common prefixes of neighbours tell which are equal: of
those, the first stays. Equal segments are one string with many places; they
are merged before they travel, so that a passage that a third of all documents
share reaches its part about once from each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.shingles import CHUNK, mix
from lattica.llm.suffixes import equal_to_previous, suffix_array

LENGTH = 100
GRAM = 36
GRAMS = LENGTH - GRAM + 1
#: Parts for each shuffle partition; a part is sorted at once, in memory.
PARTS = 8

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_NULL_ID = -(1 << 63)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    while len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            had = _powers[k]
            step = had[-1:] * base
            _powers[k] = np.concatenate([had, had * step])
    return _powers[0], _powers[1]


def _segments(data: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, first starts and numbers of starts of the segments of a text's bytes; on request, which hold their key's sequence more than once."""
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1])
    m = len(grams)
    blocks = np.concatenate([grams, np.full(-m % GRAMS, _TOP)]).reshape(-1, GRAMS)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(since[: m - GRAMS + 1], upto[GRAMS - 1 : m])
    starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    keys, sizes = least[starts], np.diff(np.r_[starts, len(least)])
    twice = np.zeros(len(keys), bool)
    if places:
        among = np.add.reduceat((grams[: len(least)] == least).astype(np.int64), starts)
        # beyond the last start, the sequences that its string holds
        tail = np.lib.stride_tricks.sliding_window_view(np.concatenate([grams, np.zeros(GRAMS, np.uint64)]), GRAMS)
        twice = among + (tail[starts + sizes][:, : GRAMS - 1] == keys[:, None]).sum(1) > 1
    return keys, starts, sizes, twice


def _bytes(texts: pa.Array) -> Iterator[np.ndarray]:
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield data[a:b]


def _pieces(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """A long text piece by piece, each string in one of them."""
    for at in range(0, max(1, len(data) - LENGTH + 1), CHUNK):
        yield at, data[at : at + CHUNK + LENGTH - 1]


_PART_SCHEMA = pa.schema([("part", pa.int32()), ("packed", pa.binary())])
_KEYED = np.dtype([("key", np.uint64), ("id", np.int64), ("hash", np.int64)])


def _deal(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """(key, id, hash) of each segment, packed by the key's part; twice for a segment that repeats its key within."""
    for batch in batches:
        ids, hashes = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        found = []
        for i, data in enumerate(_bytes(batch.column(2))):
            for _, piece in _pieces(data):
                keys, _, _, twice = _segments(piece, places=True)
                keys = np.concatenate([keys, keys[twice]])
                own = np.empty(len(keys), _KEYED)
                own["key"], own["id"], own["hash"] = keys, ids[i], hashes[i]
                found.append(own)
        entries = np.concatenate(found) if found else np.empty(0, _KEYED)
        part = (mix(entries["key"]) % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((entries["key"], part))
        entries, part = entries[order], part[order]
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, int)
        yield pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]], pa.int32()), pa.array([entries[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], schema=_PART_SCHEMA)


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """The packed values of one part after the other."""
    held: list[bytes] = []
    current = None
    for batch in batches:
        for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if part != current and held:
                yield held
                held = []
            current = part
            held.append(packed)
    if held:
        yield held


_KEYS_SCHEMA = pa.schema([("id", pa.int64()), ("hash", pa.int64()), ("key", pa.int64())])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, hash, key) of the keys that occur twice or more."""
    for held in _by_part(batches):
        e = np.frombuffer(b"".join(held), _KEYED)
        e = e[np.argsort(e["key"], kind="stable")]
        same = np.zeros(len(e), bool)
        same[1:] = e["key"][1:] == e["key"][:-1]
        same[:-1] |= same[1:]
        e = e[same]
        for a in range(0, len(e), 65536):
            x = e[a : a + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x["id"])), pa.array(np.ascontiguousarray(x["hash"])), pa.array(x["key"].view(np.int64) if x["key"].flags.c_contiguous else np.ascontiguousarray(x["key"]).view(np.int64))], schema=_KEYS_SCHEMA)


#: text: bytes of the segment's own text that follow the heads; 0 if an equal segment of the batch starts earlier.
_HEAD = np.dtype([("id", np.int64), ("hash", np.int64), ("start", np.int32), ("starts", np.int32), ("text", np.int32)])


def _pack(found: dict[bytes, list[tuple[int, int, int]]]) -> bytes:
    heads, bodies = [], []
    for body, places in found.items():
        first = min(places)
        n = len(body) - LENGTH + 1
        heads.append((first[0], first[2], first[1], n, len(body)))
        bodies.append(body)
        heads.extend((i, h, s, n, 0) for i, s, h in places if (i, s) > first[:2])
    packed = np.array(heads, _HEAD).tobytes()
    return len(heads).to_bytes(8, "little") + packed + b"".join(bodies)


def _cut(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Segments of repeated keys, with their text, packed by part; columns id, hash, text, keys."""
    for batch in batches:
        ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keys = batch.column(3)
        by_part: dict[int, dict[bytes, list[tuple[int, int, int]]]] = {}
        for i, data in enumerate(_bytes(batch.column(2))):
            if not keys[i].is_valid:
                continue
            wanted = keys[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
            for at, piece in _pieces(data):
                key, start, starts, _ = _segments(piece)
                keep = np.isin(key, wanted)
                raw = piece.tobytes()
                part = (mix(key[keep]) % np.uint64(parts)).tolist()
                for p, s, n in zip(part, start[keep].tolist(), starts[keep].tolist(), strict=True):
                    by_part.setdefault(p, {}).setdefault(raw[s : s + n + LENGTH - 1], []).append((ids[i], at + s, hashes[i]))
        if by_part:
            yield pa.RecordBatch.from_arrays([pa.array(list(by_part), pa.int32()), pa.array([_pack(x) for x in by_part.values()], pa.binary())], schema=_PART_SCHEMA)


_SPAN_SCHEMA = pa.schema([("id", pa.int64()), ("hash", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of bytes that go, as (id, hash, start, end); they may overlap."""
    for held in _by_part(batches):
        heads, texts = [], []
        for packed in held:
            n = int.from_bytes(packed[:8], "little")
            head = np.frombuffer(packed, _HEAD, n, 8)
            at = 8 + n * _HEAD.itemsize
            for size in head["text"][head["text"] > 0].tolist():
                texts.append(packed[at : at + size])
                at += size
            heads.append(head)
        held.clear()
        every = np.concatenate(heads)
        gone = every[every["text"] == 0]
        own = every[every["text"] > 0]
        order = np.lexsort((own["start"], own["id"]))
        own, texts = own[order], [texts[k] for k in order.tolist()]
        first: dict[bytes, int] = {}
        new = np.zeros(len(own), bool)
        again = np.zeros(len(own), bool)
        for k, text in enumerate(texts):
            f = first.setdefault(text, k)
            new[k] = f == k
            again[k] = f != k and (own["id"][f], own["start"][f]) != (own["id"][k], own["start"][k])
        gone = np.concatenate([gone, own[again]])
        starts = [gone["start"]]
        ends = [gone["start"] + gone["starts"] + LENGTH - 1]
        ids, hashes = [gone["id"]], [gone["hash"]]
        kept = own[new]
        text = np.frombuffer(b"".join(t for k, t in enumerate(texts) if new[k]), np.uint8)
        texts.clear()
        text = np.concatenate([text + np.uint8(1), np.zeros(LENGTH + 16, np.uint8)])
        begin = np.r_[0, np.cumsum(kept["text"])].astype(np.int64)
        wanted = np.zeros(len(text) + 1, np.int32)
        np.add.at(wanted, begin[:-1], 1)
        np.add.at(wanted, begin[:-1] + kept["starts"], -1)
        wanted = np.cumsum(wanted[:-1]) > 0
        array = suffix_array(text, wanted, LENGTH)
        if len(array):
            same = equal_to_previous(text, array, LENGTH)
            group = np.flatnonzero(~same)
            # segments lie in the order of id and start, so the earliest string of a group lies first
            earliest = np.repeat(np.minimum.reduceat(array, group), np.diff(np.r_[group, len(array)]))
            segment = np.searchsorted(begin, array, "right") - 1
            other = np.searchsorted(begin, earliest, "right") - 1
            place = kept["start"][segment] + array - begin[segment]
            place_of = kept["start"][other] + earliest - begin[other]
            later = (kept["id"][segment] != kept["id"][other]) | (place != place_of)
            removed = np.zeros(len(text) + 1, bool)
            removed[array[later]] = True
            edge = np.diff(removed[:-1].astype(np.int8), prepend=0)
            segment_start = np.zeros(len(text), bool)
            segment_start[begin[:-1]] = True
            a = np.flatnonzero((edge > 0) | (removed[:-1] & segment_start))
            stop = ~removed[:-1] | segment_start
            next_stop = np.minimum.accumulate(np.where(stop, np.arange(len(text)), len(text))[::-1])[::-1]
            b = next_stop[np.minimum(a + 1, len(text) - 1)]
            segment = np.searchsorted(begin, a, "right") - 1
            shift = kept["start"][segment] - begin[segment]
            ids.append(kept["id"][segment])
            hashes.append(kept["hash"][segment])
            starts.append((a + shift).astype(np.int32))
            ends.append((b + shift + LENGTH - 1).astype(np.int32))
        columns = [np.concatenate(x) for x in (ids, hashes, starts, ends)]
        for a in range(0, len(columns[0]), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c[a : a + 65536]), t) for c, t in zip(columns, _SPAN_SCHEMA.types, strict=True)], schema=_SPAN_SCHEMA)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans, none touching another, that cover the same bytes."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
_RESULT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _remove(batches: Iterator[pa.RecordBatch], with_kept: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        spans = batch.column(2)
        for i, data in enumerate(_bytes(batch.column(1))):
            doc_id = batch.column(0)[i].as_py()
            raw = data.tobytes()
            merged = merge_spans([(s["start"], s["end"]) for s in spans[i].as_py()]) if spans[i].is_valid else []
            kept, at = [], 0
            for a, b in merged:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            left = b"".join(kept)
            rows.append((None if doc_id == _NULL_ID else doc_id, len(raw), len(raw) - len(left), len(merged), hashlib.sha256(left).hexdigest(), left if with_kept else None))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 6, _RESULT_SCHEMA.types, strict=True)], schema=_RESULT_SCHEMA)


def remove_repeats(docs: DataFrame, with_kept: bool = True) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept).

    ``kept`` are the remaining bytes, one after the other, null unless asked
    for; they need not be whole characters. Null texts are empty. A null id
    comes before all others, and rows without an id are told apart by their
    text. Rows that repeat an id and text are one document. An empty table
    gives an empty table. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) * PARTS
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"), F.xxhash64("text").alias("hash"), "text")
    dealt = rows.mapInArrow(lambda b: _deal(b, parts), "part int, packed binary").repartition(parts // PARTS, "part").sortWithinPartitions("part")
    keys = dealt.mapInArrow(_repeated, "id long, hash long, key long").groupBy("id", "hash").agg(F.collect_set("key").alias("keys"))
    # both joins shuffle the same rows alike, so the texts travel once
    found = rows.join(keys, ["id", "hash"], "left").where("keys is not null").select("id", "hash", "text", "keys").mapInArrow(lambda b: _cut(b, parts), "part int, packed binary")
    spans = found.repartition(parts // PARTS, "part").sortWithinPartitions("part").mapInArrow(_spans, "id long, hash long, start int, end int")
    spans = spans.groupBy("id", "hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return rows.join(spans, ["id", "hash"], "left").select("id", "text", "spans").mapInArrow(lambda b: _remove(b, with_kept), _RESULT)
