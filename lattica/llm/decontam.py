"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts and documents are cut into words alike. The automaton's
alphabet is the benchmark's words, one code for each; it holds every window of
``WINDOW`` consecutive words of an item, or the whole of a shorter item. A
document is scanned once, word by word: its words become codes, words that no
item has all become one code that occurs in no window, and every window that
ends anywhere is reported. Word numbers map back to offsets in the original.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 13
#: Benchmark text in one automaton, in bytes; a larger benchmark is scanned in as many automata as it needs.
AUTOMATON_BYTES = 32_000_000

#: Maps a UTF-8 byte to the byte of its word, or to a space: digits, letters (lower-cased) and all that is not ASCII stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Codes take two characters, so that any number of words has one: a first and a second from ranges that don't meet.
_FIRST, _SECOND, _SPAN = 0x10000, 0x90000, 1 << 18
_OTHER = "\x01\x02"

HITS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    ]
)


def words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case, as UTF-8; null has none."""
    return [] if text is None else text.encode().translate(_FOLD).split()


def word_offsets(text: str) -> list[tuple[int, int]]:
    """Start and end of each word, in characters of the original."""
    return [m.span() for m in _WORD.finditer(text)]


class Windows:
    """The automaton over the windows of (item id, text) pairs."""

    def __init__(self, items: list[tuple[str, str | None]]) -> None:
        self.codes: dict[bytes, str] = {}
        owners: dict[str, tuple[int, set[str]]] = {}
        for item, text in items:
            code = [self.codes.setdefault(w, chr(_FIRST + (n := len(self.codes)) // _SPAN) + chr(_SECOND + n % _SPAN)) for w in words(text)]
            for at in range(max(1, len(code) - WINDOW + 1)) if code else ():
                part = code[at : at + WINDOW]
                owners.setdefault("".join(part), (len(part), set()))[1].add(item)
        self.automaton = ahocorasick.Automaton()
        for window, (n, ids) in owners.items():
            self.automaton.add_word(window, (n, frozenset(ids)))
        if owners:
            self.automaton.make_automaton()

    def find(self, code: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Stretches of words inside windows, as (first, after the last), disjoint and in order, and the items found."""
        runs: list[list[int]] = []
        found: set[str] = set()
        if not len(self.automaton):
            return [], found
        get = self.codes.get
        for end, (n, ids) in self.automaton.iter("".join([get(w, _OTHER) for w in code])):
            last = end // 2 + 1
            first = last - n
            found |= ids
            while runs and first <= runs[-1][1]:
                first = min(first, runs.pop()[0])
            runs.append([first, last])
        return [(a, b) for a, b in runs], found


#: The automata in this process: a broadcast's name, and one automaton of it.
_READY: dict[tuple[str, int], Windows] = {}


def _windows(name: str, part: int, items: list[tuple[str, str | None]]) -> Windows:
    if (name, part) not in _READY:
        _READY.clear()
        _READY[name, part] = Windows(items)
    return _READY[name, part]


def _joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(batches: Iterator[pa.RecordBatch], parts: Broadcast) -> Iterator[pa.RecordBatch]:
    name, blocks = parts.value
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
    for batch in batches:
        texts = batch.column(1)
        found: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in range(len(texts))]
        counts = [0] * len(texts)
        for part, items_of in enumerate(blocks):
            windows = _windows(name, part, items_of)
            for i in range(len(texts)):
                code = words(texts[i].as_py())
                counts[i] = len(code)
                runs, items = windows.find(code)
                if items:
                    found[i][0].extend(runs)
                    found[i][1].update(items)
        spans = []
        hits = []
        for i, (runs, items) in enumerate(found):
            runs = _joined(runs)
            at = word_offsets(texts[i].as_py()) if runs else []
            spans.append([{"start": at[a][0], "end": at[b - 1][1]} for a, b in runs])
            hits.append(sum(b - a for a, b in runs))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), pa.array([sorted(x) for _, x in found], pa.list_(pa.string())), pa.array(spans, schema.field("spans").type)], schema=schema)


def _blocks(benchmark: DataFrame) -> Broadcast:
    """The benchmark's (item id, text), broadcast in blocks of at most AUTOMATON_BYTES each, or one text."""
    parts: list[list[tuple[str, str | None]]] = [[]]
    size = 0
    for row in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), "text").toLocalIterator():
        if size and size + len(row.text or "") > AUTOMATON_BYTES:
            parts.append([])
            size = 0
        parts[-1].append((row.i, row.text))
        size += len(row.text or "")
    return benchmark.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, parts))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_words, n_hit, item_ids, spans).

    ``spans`` are the maximal stretches of hit words, in characters of the
    original text. Null texts and ids are kept: a null text has no words; items
    of null text have no windows, a null item id reads as empty. Items that
    occur repeatedly count once; rows of ``docs`` that repeat are scanned each.
    An empty benchmark hits nothing. Columns other than doc_id, text, item_id
    are not read.

    The benchmark, a stated query set, is broadcast in blocks of at most
    ``AUTOMATON_BYTES`` (or one text), one automaton each, and every batch of
    documents meets them all, one after the other.
    """
    shared = _blocks(benchmark)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda batches: _scan(batches, shared), HITS)


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """The rule: something is hit, and at least one word of twenty."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, all columns, without a shuffle of texts."""
    verdict = benchmark_flag(benchmark)
    return docs.where(~verdict(F.col("text")))


def benchmark_flag(benchmark: DataFrame):  # noqa: ANN201
    """A function of a text column: whether the text is contaminated."""
    shared = _blocks(benchmark)

    @F.arrow_udf("boolean")
    def flag(texts: pa.Array) -> pa.Array:
        ids = pa.nulls(len(texts), pa.int64())
        out = next(_scan(iter([pa.RecordBatch.from_arrays([ids, texts], names=["doc_id", "text"])]), shared))
        return pa.array([h > 0 and 20 * h >= n for n, h in zip(out.column(1).to_pylist(), out.column(2).to_pylist(), strict=True)], pa.bool_())

    return flag
