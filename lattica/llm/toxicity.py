"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text.
A text is cut into windows, and each window is compressed with either: the
bytes that the toxic dictionary saves over the ordinary one are the window's
gain. How many windows reach which gain, against the number of windows, gives
the score; its weights are calibrated on labelled texts that trained neither
dictionary.

Training a dictionary means choosing its content. The toxic one takes words of
toxic texts whose letter sequences are far more common there than in ordinary
texts, as few as cover the most. The ordinary one takes, round by round, words
of ordinary texts that the toxic one would shorten most, so that what both
kinds of text share saves nothing.

Every labelled text in training counts, in whole. Words and letter sequences
are counted where the texts lie; only the best words, the candidates of a round
and sums over blocks of calibrated texts reach the driver.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.llm.common import written

#: Of the labelled texts, the share that trains dictionaries; the rest calibrates.
FIT = 0.6
THRESHOLD = 0.7
#: Words in a window.
WINDOW = 1
#: Content of a dictionary, in bytes and in words.
DICTIONARY_BYTES = 1024
DICTIONARY_WORDS = 120
ROUNDS, PER_ROUND = 2, 40
GRAM = 5
LEVEL = 9
#: Features count up to so many standard deviations from their mean.
REACH = 4.0
#: Gains of windows that a process remembers.
REMEMBERED = 150_000
#: Hash values that ids are cut by; labelled texts in a block of the calibration; as many of them as the driver takes, else tasks sum up.
BINS, PER_BLOCK, AT_DRIVER = 4096, 4096, 50_000
#: Toxic words that reach the driver at first, best ones first; more if these don't settle the choice.
CANDIDATES = 20_000
#: Words and sequences that a task counts before it hands them on.
COUNTED = 200_000

Gain = dict[bytes, int]

#: Stands at the end of both dictionaries, and half of it before and half after each window. A short window alone would be
#: stored as it is and show no gain, and no match is sought in the last few bytes.
_LEAD = bytes(range(128, 160))


def _words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def _grams(word: bytes) -> set[bytes]:
    padded = b" " + word + b" "
    return {padded[k : k + GRAM] for k in range(max(1, len(padded) - GRAM + 1))}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (toxic, text) rows: in how many texts of either label a word, and a sequence, occurs."""
    counts: Counter[tuple[int, bytes, int]] = Counter()
    known: dict[bytes, set[bytes]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        if counts:
            kind, unit, label = zip(*counts, strict=True)
            n = list(counts.values())
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(unit, pa.binary()), *[pa.array([k * (y == of) for k, y in zip(n, label, strict=True)], pa.int64()) for of in (0, 1)]], names=["kind", "unit", "n0", "n1"])
            counts.clear()

    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            bag = set(_words(text.as_py()))
            grams: set[bytes] = set()
            for word in bag:
                of = known.get(word)
                if of is None:
                    of = _grams(word)
                    if len(word) < DICTIONARY_BYTES:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[word] = of
                grams |= of
            counts.update((1, w, label) for w in bag)
            counts.update((0, g, label) for g in grams)
            if len(counts) >= COUNTED:
                yield from out()
    yield from out()


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def _grams_of(words: pd.Series) -> pd.Series:
    return words.map(lambda w: sorted(_grams(bytes(w))))


def _telling_words(units: DataFrame, toxic: int, ordinary: int) -> list[bytes]:
    """Words of toxic texts that together cover the sequences most particular to them, best first.

    ``toxic`` and ``ordinary`` are numbers of texts. What a word is worth only
    falls as others are chosen, so words beyond the candidates don't matter as
    long as those chosen are worth more than the last candidate was at first.
    """
    per = max(1, ordinary)  # worths are multiplied by it, to be whole numbers
    least = max(1, min(4, toxic // 50))
    worth = units.where("kind = 0").select(F.col("unit").alias("gram"), (F.col("n1") * per - F.col("n0") * 3 * max(1, toxic) - least * per).alias("worth")).where("worth > 0")
    words = units.where((F.col("kind") == 1) & (F.col("n1") > 0) & (F.length("unit") < DICTIONARY_BYTES // 8)).select(F.col("unit").alias("word"))
    valued = words.select("word", F.explode(_grams_of("word")).alias("gram")).join(worth, "gram").groupBy("word").agg(F.sum("worth").alias("v"), F.collect_list(F.struct("gram", "worth")).alias("grams"))
    valued, many = written(valued, "toxicity-words"), CANDIDATES
    while True:
        rows = valued.orderBy(F.desc("v"), "word").limit(many).collect()
        of = {bytes(r.word): sorted((bytes(g.gram), g.worth) for g in r.grams) for r in rows}
        heap = [(-r.v, bytes(r.word)) for r in rows]
        bound = rows[-1].v if len(rows) == many else 0
        covered: set[bytes] = set()
        out: list[bytes] = []
        heapq.heapify(heap)
        while heap and len(out) < DICTIONARY_WORDS:
            _, word = heapq.heappop(heap)
            now = sum(v for g, v in of[word] if g not in covered)
            if now <= 0:
                continue
            if heap and -now > heap[0][0]:
                heapq.heappush(heap, (-now, word))
                continue
            if now <= bound:  # a word beyond the candidates might be worth as much
                break
            out.append(word)
            covered |= {g for g, _ in of[word]}
        else:
            return out
        if not bound:
            return out
        many *= 4


def _content(words: Sequence[bytes]) -> bytes:
    """The best words last, where they cost least to point at; always of one length, so that distances compare."""
    return (b" " + b" ".join(reversed(words)) + b" ")[-DICTIONARY_BYTES:].rjust(DICTIONARY_BYTES) + _LEAD


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    trained.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=False, write_checksum=False, write_dict_id=False)


@dataclass
class Model:
    """Two dictionaries and the calibration; small, and the same for every size of corpus."""

    toxic: bytes
    ordinary: bytes
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    constant: float | None = None

    def __post_init__(self) -> None:
        self._ready: tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor] | None = None
        self._gains: Gain = {}

    def __getstate__(self) -> dict[str, object]:
        return self.__dict__ | {"_ready": None, "_gains": {}}

    def gain(self, window: bytes) -> int:
        """Bytes that the toxic dictionary saves over the ordinary one."""
        if self._ready is None:
            self._ready = _compressor(self.toxic), _compressor(self.ordinary)
        padded = _LEAD[:16] + b" " + window + b" " + _LEAD[16:]
        return len(self._ready[1].compress(padded)) - len(self._ready[0].compress(padded))

    def counts(self, text: str | None) -> list[int]:
        """How many windows gain 2, 3, 4, 5, and 6 or more, how many lose 2 or more, and how many there are."""
        words = _words(text)
        windows = Counter(words if WINDOW == 1 else [b" ".join(words[i : i + WINDOW]) for i in range(0, len(words), WINDOW)])
        out = [0] * 7
        known = self._gains
        for window, n in windows.items():
            g = known.get(window)
            if g is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                g = known[window] = self.gain(window)
            if g >= 2:
                out[min(g, 6) - 2] += n
            elif g <= -2:
                out[5] += n
            out[6] += n
        return out

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(counts), self.constant)
        z = np.clip((_features(counts) - self.mean) / self.scale, -REACH, REACH)
        odds = 1 / (1 + np.exp(-np.clip(z @ self.weights[:-1] + self.weights[-1], -30, 30)))
        return np.where(counts[:, -1] > 0, odds, 0.0)


def _features(counts: np.ndarray) -> np.ndarray:
    n = np.maximum(counts[:, -1:], 1)
    some = counts[:, :-1]
    return np.hstack([np.log1p(some), np.minimum(some / n * 50, 5), np.log1p(n), some > 0])


def _sums(counts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Number, rows of label 1, and sums and sums of squares of the features."""
    x = _features(counts)
    return np.concatenate([[len(x), labels.sum()], x.sum(0), (x * x).sum(0)])


def _newton(counts: np.ndarray, labels: np.ndarray, model: Model, w: np.ndarray, weights: tuple[float, float]) -> np.ndarray:
    """A block's part of the second and the first derivatives."""
    z = np.hstack([np.clip((_features(counts) - model.mean) / model.scale, -REACH, REACH), np.ones((len(counts), 1))])
    rows = np.where(labels == 1, weights[1], weights[0])
    p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
    return np.concatenate([((z * (rows * p * (1 - p) + 1e-6)[:, None]).T @ z).ravel(), z.T @ (rows * (p - labels))])


def _arrays(labels: Sequence[int], counts: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    return np.array(counts, dtype=np.int64).reshape(-1, 7), np.array(labels, dtype=np.int64)


def _summing(blocks: DataFrame, total: int) -> Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray]], np.ndarray]:
    """Adds up what a function of (counts, labels) gives for each block, always in the order of blocks, so that equal inputs give equal sums."""
    if total <= AT_DRIVER:
        held = [_arrays(r.labels, r.counts) for r in blocks.orderBy("block").collect()]
        return lambda f: np.sum([f(*x) for x in held], axis=0)

    def over(f: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array([f(*_arrays(r["labels"], r["counts"])).tolist() for r in rows], pa.list_(pa.float64()))], names=["block", "sums"])

        found = blocks.select("block", "labels", "counts").mapInArrow(part, "block long, sums array<double>").collect()
        return np.sum([r.sums for r in sorted(found, key=lambda r: r.block)], axis=0)

    return over


def _calibrate(model: Model, over: Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray]], np.ndarray], share: float) -> None:
    """Logistic weights by Newton's method, rows weighed to the share that the labels have in all."""
    n, ones, *sums = over(_sums)
    width = len(sums) // 2
    model.mean = np.array(sums[:width]) / n
    model.scale = np.sqrt(np.maximum(np.array(sums[width:]) / n - model.mean**2, 0)) + 0.05
    here = ones / n
    weights = (1 - share) / max(1 - here, 1e-9), share / max(here, 1e-9)
    held = np.r_[np.full(width, 0.3), 1e-3]
    w = np.zeros(width + 1)
    for _ in range(30):
        found = over(lambda counts, labels, w=w: _newton(counts, labels, model, w, weights))
        step = np.linalg.solve(found[: -width - 1].reshape(width + 1, width + 1) + np.diag(held), found[-width - 1 :] + held * w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    model.weights = w


def in_training(doc_id: Column) -> Column:
    """Whether a row's label may be learned: not for a third of the ids, which are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def _cuts(rows: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Rows of either label, and the hash value under which FIT of them, two at least, train the dictionaries."""
    bins: dict[int, dict[int, int]] = {0: {}, 1: {}}
    for r in rows.groupBy("toxic", "_bin").count().collect():
        bins[r.toxic][r._bin] = r["count"]
    sizes, cuts = {y: sum(b.values()) for y, b in bins.items()}, {}
    for label, found in bins.items():
        upto, cuts[label] = 0, 0
        for k in sorted(found):
            if upto >= max(2, int(sizes[label] * FIT)):
                break
            upto += found[k]
            cuts[label] = k + 1
    return sizes, cuts


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from all labelled rows in training, whole texts.

    Labels other than 0 and 1 and null ids don't count; an id that is labelled
    twice is toxic if either label is; of an id with several texts the least
    counts. The share of either label is counted over all labels in training.
    Without four texts of either label every score is the share of label 1, 0
    if there are no labels. Equal inputs give equal models.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & in_training(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    shares = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = shares.get(1, 0) / max(1, sum(shares.values()))
    rows = docs.where(in_training(F.col("doc_id"))).select("doc_id", "text").join(known, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = rows.withColumn("_h", F.md5(F.col("doc_id").cast("string").cast("binary")))
    rows = written(rows.withColumn("_bin", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int")), "toxicity-labelled")
    sizes, cuts = _cuts(rows)
    if min(sizes.values()) < 4:
        return Model(_content([]), _content([]), constant=min(max(share, 0.0), 1.0))
    fits = F.col("_bin") < F.when(F.col("toxic") == 1, cuts[1]).otherwise(cuts[0])
    texts = rows.where(fits)
    numbers = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    counted = texts.select("toxic", "text").mapInArrow(_count, "kind int, unit binary, n0 long, n1 long")
    units = written(counted.groupBy("kind", "unit").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "toxicity-units")
    model = Model(_content(_telling_words(units, numbers.get(1, 0), numbers.get(0, 0))), _content([]))
    seen = units.where((F.col("kind") == 1) & (F.col("n0") > 0) & (F.length("unit") < 40))
    alike: list[bytes] = []
    for _ in range(ROUNDS):
        saved = seen.select("unit", "n0", _gain_udf(model)("unit").alias("g")).where("g >= 2").select("unit", (F.col("n0") * F.col("g")).alias("v"))
        alike += [w for r in saved.orderBy(F.desc("v"), F.desc("unit")).limit(PER_ROUND).collect() if (w := bytes(r.unit)) not in alike]
        model = Model(model.toxic, _content(alike))
    rest = rows.where(~fits)
    total = rest.count()
    block = F.pmod(F.conv(F.substring("_h", 4, 12), 16, 10).cast("long"), F.lit(max(1, total // PER_BLOCK))).alias("block")
    blocks = rest.select(block, F.struct("_h", "doc_id", "toxic", _counts_udf(model)("text").alias("counts")).alias("row")).groupBy("block").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    blocks = written(blocks.select("block", F.col("rows.toxic").alias("labels"), F.flatten("rows.counts").alias("counts")), "toxicity-counts")
    if total:
        _calibrate(model, _summing(blocks, total), share)
        return model
    return Model(model.toxic, model.ordinary, constant=min(max(share, 0.0), 1.0))


def _gain_udf(model: Model):  # noqa: ANN202
    @F.pandas_udf("long")
    def gain(words: pd.Series) -> pd.Series:
        return words.map(lambda w: model.gain(bytes(w))).astype("int64")

    return gain


def _counts_udf(model: Model):  # noqa: ANN202
    @F.pandas_udf("array<long>")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(model.counts)

    return counts


def score_udf(model: Model):  # noqa: ANN201
    """A function of a text column: the score, from 0 to 1; that of null texts and texts without words is 0."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(np.array([model.counts(t) for t in texts]).reshape(-1, 7)), dtype=float)

    return score


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from ``threshold`` on).

    Null texts read as empty. Equal texts score alike. An empty table stays
    empty. Columns ``score`` and ``predicted`` of ``docs`` are replaced; all
    others stay.
    """
    return docs.withColumn("score", score_udf(model)(F.col("text"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
