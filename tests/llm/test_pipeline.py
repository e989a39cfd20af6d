"""The corpus pipeline, stage by stage, against plain versions; and its query functions' digest columns."""

import hashlib
import random
import zlib

import pytest

import corpus_pipeline
from lattica.llm import mixing, queries, toxicity
from tests.llm.test_operators import brute_hits, components, words_of

BAD = ["vilest", "scumbag", "moronic", "rotten"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(6)
    words = ["".join(r.choices("abcdeinorst", k=r.randint(2, 7))) for _ in range(200)]
    bench = [" ".join(r.choices(words, k=20)) for _ in range(5)]
    rows, labels = [], []
    for i in range(400):
        w = r.choices(words, k=r.randint(20, 60))
        toxic = i % 5 == 0
        for _ in range(4 * toxic):
            w[r.randrange(len(w))] = r.choice(BAD)
        if i % 11 == 3:
            w = rows[r.randrange(len(rows))][1].split() + ["tail"]
            toxic = any(b in w for b in BAD)
        text = " ".join(w)
        if i % 13 == 7:
            text += " " + bench[i % 5]
        rows.append((i, text, "en", r.choice(["x", "y", None]), len(text)))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, None, "en", "x", 0), (1001, "", "en", None, 0), (None, "just words here", "en", "y", 5), (3, rows[3][1], "en", rows[3][3], 1)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def seen(df):
    return sorted((tuple(map(str, (r.doc_id, r.text, r.lang, r.source, r.n_chars))) for r in df.collect()))


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        kept = [(r.doc_id, r.text) for r in out.collect()]
        if name == "toxicity":
            gone = {r.doc_id for r in docs.collect()} - {i for i, _ in kept}
            assert all(i is not None and any(b in words_of(t) for b in BAD) for i, t, _ in rows if i in gone) and len(gone) > 40
            left = [i for i, t in kept if any(b in words_of(t) for b in BAD)]
            assert len(left) <= 0.1 * len(gone)
        elif name == "ngram_jaccard":
            assert sorted(str(i) for i, _ in kept) == sorted([*{str(c) for c in components(rows).values()}, "None"])
        elif name == "decontamination":
            clean = []
            for i, t, _ in rows:
                n, hit, _ = brute_hits(t, bench)
                if not (hit and 20 * hit >= n):
                    clean.append((str(i), str(t)))
            assert sorted((str(i), str(t)) for i, t in kept) == sorted(clean) and len(clean) < len(rows)
        elif name == "mixing":
            want = {}
            for r in mixing.mix_plan(docs).collect():
                want[str(r.doc_id)] = want.get(str(r.doc_id), 0) + r.copies
            found = {}
            for i, _ in kept:
                found[str(i)] = found.get(str(i), 0) + 1
            assert found == {i: n for i, n in want.items() if n}
        else:
            assert seen(out) == seen(docs)
            for s in range(24):
                slots = sorted(r.slot for r in out.collect() if r.shard == s)
                assert slots == list(range(len(slots)))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = out
    assert sorted(map(str, corpus_pipeline.run(spark, folder).select("doc_id", "shard", "slot").collect())) == sorted(map(str, docs.select("doc_id", "shard", "slot").collect()))


def test_empty_tables_pass(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_query_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = queries.op8_decontamination(spark, folder).collect()
    want = []
    for r in docs:
        n, hit, items = brute_hits(r.text, bench)
        want.append((str(r.doc_id), n, hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), bool(hit and 20 * hit >= n)))
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == sorted(want)
    for r in queries.op3_toxicity(spark, folder).collect():
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) or r.doc_id is None
        assert r.predicted == int(r.score >= toxicity.THRESHOLD)
    for r in queries.op5_sharding(spark, folder).collect():
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 24


def test_scores_repeat(spark, folder):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    twice = docs.union(docs.selectExpr("doc_id", "concat(text, ' more')", "lang", "source", "n_chars"))
    a, b = toxicity.fit(twice, labels), toxicity.fit(twice.repartition(7), labels.repartition(5))
    assert a.toxic == b.toxic and a.ordinary == b.ordinary and a.weights.tolist() == b.weights.tolist()


def test_every_labelled_text_trains(spark, monkeypatch):
    """A word of toxic texts that come late in the order of hashes, as short texts and as texts of over 100 kB."""
    ids = [i for i in range(8000) if zlib.crc32(str(i).encode()) % 3 != 1]
    toxic = sorted((i for i in ids if i % 2), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    late = set(toxic[1500 : int(len(toxic) * toxicity.FIT) - 5])
    assert len(late) > 50
    rows = [(i, f"plain words here {'vilest' * (i % 2)} {'qzxlate' if i in late else ''}") for i in ids]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in ids], "doc_id long, quality int, toxic int")
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert b"vilest" in model.toxic and b"qzxlate" in model.toxic
    long = spark.createDataFrame(rows[:60], "doc_id long, text string").selectExpr("doc_id", "concat(text, repeat(' filler', 20000)) as text")
    first = toxicity.fit(long, labels)
    assert first.constant is None and b"vilest" in first.toxic
    monkeypatch.setattr(toxicity, "AT_DRIVER", 0)
    monkeypatch.setattr(toxicity, "CANDIDATES", 1)
    again = toxicity.fit(long.repartition(5), labels)
    assert again.toxic == first.toxic and again.weights.tolist() == first.weights.tolist()
