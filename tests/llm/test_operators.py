"""Each operator against a plain version, and on nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lattica.llm import decontam, htmltext, jaccard, licenses, media, mixing, sharding, substrings, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, shard string, size string, score string, copies string"


def table(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, 0, "a", "b", "c", "d", "e") for i, t, s in rows], DOCS)


def corpus(seed=0, n=120):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdefgh", k=r.randint(1, 6))) for _ in range(60)]
    base = [" ".join(r.choices(words, k=r.choice([0, 1, 3, 4, 5, 6, 12, 40, 90]))) for _ in range(n)]
    rows = []
    for i, text in enumerate(base):
        kind = r.random()
        if kind < 0.25 and i:
            text = base[r.randrange(i)]
        elif kind < 0.6 and i:
            copy = base[r.randrange(i)].split()
            for _ in range(r.randint(0, 3)):
                if copy:
                    copy[r.randrange(len(copy))] = r.choice(words)
            text = " ".join(copy)
        if kind > 0.9:
            text = " ".join(base[:3]) + " " + text
        base[i] = text
        rows.append((i * 3, text if kind < 0.97 else None, r.choice(["x", "y", "é", None])))
    rows += [(1000, "", "x"), (1001, " \t\n", None), (1002, "Ab " * 4000, "z"), (None, base[5], "x"), (None, None, None), (7 * 3, base[7], "x")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words_of(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(rows):
    sets = [(i, shingles(t)) for i, t, _ in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    return {i: find(i) for i in parent}


@pytest.mark.parametrize("region, sample, stuck, per_task", [(64, 8192, 512, 512), (2, 8, 4, 3)])
def test_jaccard_components(docs, rows, monkeypatch, region, sample, stuck, per_task):
    for name, value in (("REGION", region), ("SAMPLE", sample), ("SHARE", 20), ("STUCK", stuck), ("PER_TASK", per_task), ("DENSE", 1 if region == 2 else 4)):
        monkeypatch.setattr(jaccard, name, value)
    got = jaccard.jaccard_components(docs).collect()
    assert len(got) == len(rows)
    want = components(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {*want.items(), (None, None)}
    assert sorted(r.n_shingles for r in got) == sorted(len(shingles(t)) for _, t, _ in rows)


def test_jaccard_keeps_one(docs, rows):
    want = components(rows)
    kept = [r.doc_id for r in jaccard.keep_one(docs).collect()]
    assert sorted(i for i in kept if i is not None) == sorted({*want.values()})
    assert kept.count(None) == 2


def test_jaccard_keeps_one_where_ids_repeat(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    # 1: two texts of their own, one of them twice; 2: a near copy of 1's; 3: near copies of each other; 4: a near copy of 1's and a text of its own
    rows = [(1, a, "x"), (1, a, "x"), (1, b, "x"), (2, a + " z", "x"), (3, c, "x"), (3, c + " z", "x"), (4, b + " y", "x"), (4, "p q r s t u v w", "x"), (5, "", "x"), (5, "k l m n o p q", "x")]
    got = sorted((r.doc_id, r.text) for r in jaccard.keep_one(table(spark, rows)).collect())
    third = [t for i, t in got if i == 3]
    assert len(third) == 1 and third[0] in (c, c + " z")
    assert [x for x in got if x[0] != 3] == sorted([(1, a), (1, b), (4, "p q r s t u v w"), (5, ""), (5, "k l m n o p q")])


def test_jaccard_of_one_large_group(spark, monkeypatch):
    """Copies of one text, each changed at random places, more of them than a region compares without pivots."""
    r = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in range(r.randint(0, 6)):
            words[r.randrange(60)] = f"x{r.randrange(40)}"
        rows.append((i, " ".join(words), "s"))
    monkeypatch.setattr(jaccard, "PER_TASK", 32)
    got = {x.doc_id: x.component_id for x in jaccard.jaccard_components(table(spark, rows)).collect()}
    assert got == components(rows)


def test_words_made_to_collide(spark):
    word = "a"
    while len(word) < 2048:  # the Thue-Morse word and its complement agree in every polynomial modulo 2**64
        word += word.translate(str.maketrans("ab", "ba"))
    rows = [(0, word, "s"), (5, word.translate(str.maketrans("ab", "ba")), "s")]
    assert {x.component_id for x in jaccard.jaccard_components(table(spark, rows)).collect()} == {0, 5}


def test_jaccard_empty(empty):
    assert jaccard.jaccard_components(empty).count() == 0


def test_media(docs, rows, empty):
    got = {(r.doc_id, r.payload_sha256): r for r in media.store_texts(docs).collect()}
    for i, text, _ in rows:
        raw = (text or "").encode()
        filled = raw + b" " * (-len(raw) % 192 or (192 if not raw else 0))
        r = got[i, hashlib.sha256(filled).hexdigest()]
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(raw), len(filled), zlib.crc32(filled[-16:]))
        assert r.media_sha256 == hashlib.sha256(bytes(r.media)).hexdigest() and r.media_bytes == len(r.media)
        assert r.media_type == "audio/wav" and bytes(r.media[44 : 44 + len(filled)]) == filled
    assert media.store_texts(empty).count() == 0


def png(width, height):
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0" * (width + 1) * height)) + chunk(b"IEND", b"")


def test_sniff_corrects_and_carves(spark):
    gz = zlib.compressobj(wbits=31)
    packed = gz.compress(b"hello" * 50) + gz.flush()
    holder = media.store_wav(b"\x80" * 10 + png(3, 2) + b"PK\x03\x04 RIFF BM" + packed + b"\x80" * 7)
    broken = bytearray(png(4, 4))
    broken[20] ^= 1
    df = spark.createDataFrame([(1, bytearray(holder), "image/png"), (2, bytearray(png(1, 1)), "image/png"), (3, broken, "image/png"), (4, None, None), (5, bytearray(), "x")], "id int, media binary, type string")
    got = {r.id: r for r in media.sniff_column(df, "media", "type").collect()}
    assert (got[1].media_type, got[1].type_corrected) == ("audio/wav", True)
    assert [(x.type, bytes(x.bytes)) for x in got[1].carved] == [("image/png", png(3, 2)), ("application/gzip", packed)]
    assert (got[2].media_type, got[2].type_corrected) == ("image/png", False)
    assert got[3].media_type is None and got[4].media_type is None and got[5].carved == []


def test_toxicity(spark):
    r = random.Random(1)
    plain = ["".join(r.choices("abcdeinorst", k=r.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 4 == 0
        w = r.choices(plain, k=60)
        for _ in range(r.randint(2, 5) * toxic):
            w[r.randrange(60)] = "zorgq" + r.choice(["ly", "ing", "est", ""])
        rows.append((i, " ".join(w), "x"))
        labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (5, 1, None), (99999, 0, 1)]
    docs = table(spark, [*rows, (None, None, "x"), (2000, "", "y"), (2001, "zorgq " * 9000, "y")])
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = toxicity.classify(docs, model).collect()
    held = [x for x in got if x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 3 == 1 and x.doc_id < 900]
    right = sum(x.predicted == (x.doc_id % 4 == 0) for x in held)
    assert len(got) == 903 and right >= 0.97 * len(held) and all(0 <= x.score <= 1 for x in got)
    assert [x.predicted for x in got if x.text in (None, "")] == [0, 0]


def test_toxicity_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.classify(docs, toxicity.fit(docs, none)).collect()} == {0}
    assert toxicity.classify(empty, toxicity.fit(empty, none)).count() == 0


def test_warc_finds_just_the_damage(spark):
    rows = [(i * 400, f"http://h/{i}", f"<p>{i}</p>") for i in range(60)] + [(None, None, None), (None, "u", ""), (0, "http://h/0", "<p>0</p>"), (800, None, "x" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("offset", F.lit("clash"))
    harm = pages.withColumn("html", F.when(F.col("page_id").isin(4000, 12000), F.concat("html", F.lit("!"))).otherwise(F.col("html")))
    got = warc.audit(pages, harm).collect()
    assert len(got) == len(rows) and sorted(r.page_id for r in got if r.damaged) == [4000, 12000]
    assert not [r for r in warc.audit(pages, pages.repartition(7)).collect() if r.damaged]
    by_file = {}
    for r in sorted(got, key=lambda r: (r.file, r.offset)):
        assert r.offset == by_file.get(r.file, 0)
        by_file[r.file] = r.offset + r.length
    want = hashlib.sha256("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: http://h/1\r\nContent-Type: text/html\r\nContent-Length: 8\r\n\r\n<p>1</p>\r\n\r\n".encode()).hexdigest()
    assert next(r.record_sha256 for r in got if r.page_id == 400) == want
    assert warc.audit(pages.limit(0), pages.limit(0)).count() == 0


def test_warc_missing_records(spark):
    pages = spark.createDataFrame([(i, f"u{i}", "x") for i in range(50)], "page_id long, url string, html string")
    got = warc.audit(pages, pages.where("page_id <> 49")).collect()
    assert [r.page_id for r in got if r.damaged] == [49]


def test_warc_records_missing_and_added_in_the_middle(spark):
    rows = [(i, f"u{i}", "x") for i in range(0, 10_000, 40)] + [(80, "u80", "again"), (80, "u80", "again"), (None, "v", "1"), (None, "w", "1")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    more = spark.createDataFrame([(4001, "new", "y"), (80, "u80", "third"), (120, "u120", "z"), (None, "n", "2"), (90_000, "far", "y")], pages.schema)
    less = spark.createDataFrame([r for r in rows if r[0] not in (2000, 120) and r[1] != "v"][:-1] + [(None, "w", "1")], pages.schema)
    assert sorted(r.page_id for r in warc.audit(pages, pages.where("page_id <> 2000 or page_id is null")).collect() if r.damaged) == [2000]
    got = warc.audit(pages, less.union(more)).collect()
    assert sorted(str(r.page_id) for r in got if r.damaged and r.offset is not None) == ["120", "2000", "None"]
    assert sorted(str(r.page_id) for r in got if r.offset is None) == ["4001", "80", "90000", "None"]
    assert len(got) == len(rows) + 4 and all(r.damaged for r in got if r.offset is None)
    once = pages.dropDuplicates()
    assert [r.page_id for r in warc.audit(pages, once).collect() if r.damaged] == [80]
    assert [(r.page_id, r.offset) for r in warc.audit(once, pages).collect() if r.damaged] == [(80, None)]


def test_warc_trees_of_different_depth(spark):
    one = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    two = spark.createDataFrame([(1, "u", "x"), (9_000_000, "v", "y")], "page_id long, url string, html string")
    assert [r.page_id for r in warc.audit(two, one).collect() if r.damaged] == [9_000_000]
    assert not [r for r in warc.audit(one, one).collect() if r.damaged]


def test_sharding(docs, rows, empty):
    got = sharding.reshard_plan(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in got) == sorted((i is None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    for s in range(24):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.reshard_plan(empty).count() == 0


def test_sharding_balances_and_moves_little(spark):
    r = random.Random(3)
    docs = table(spark, [(i, "x" * r.randint(0, 400), "s") for i in range(6000)])
    got = sharding.reshard_plan(docs).collect()
    sizes = [sum(x["size"] for x in got if x.shard == s) for s in range(24)]
    assert max(sizes) - min(sizes) <= 0.02 * sum(sizes) / 24
    old = [sum(x["size"] for x in got if x.old_shard == s) for s in range(16)]
    least = sum(max(0, o - sum(sizes) / 24) for o in old)
    assert sum(x["size"] for x in got if x.shard != x.old_shard) <= 1.03 * least


def test_flow_is_cheapest():
    flow = sharding.min_cost_flow([7, 3], [5, 5], lambda o, s: int(o != s))
    assert flow == {(0, 0): 5, (0, 1): 2, (1, 1): 3}
    with pytest.raises(ValueError):
        sharding.min_cost_flow([7], [5], lambda o, s: 0)


def test_rewrite_touches_only_affected_shards(spark, tmp_path):
    rows = [(i, "x" * (i % 50), "k") for i in range(300)] + [(None, "no id", "k"), (None, "no id", "k"), (None, None, "l"), (7, "twice", "m"), (7, "twice", "m"), (8, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").withColumn("row", F.lit("own"))
    path = str(tmp_path / "out")
    options = dict(n_old=4, n_new=5, blocks=8)
    plan = sharding.reshard_plan(docs, **options).collect()
    changed = {s for r in plan if r.shard != r.old_shard for s in (r.shard, r.old_shard)}
    (tmp_path / "out" / "shard=77").mkdir(parents=True)
    spark.createDataFrame([(1, "kept", "own")], "doc_id long, text string, row string").write.mode("overwrite").parquet(path + "/shard=77")
    assert sharding.rewrite_shards(docs, path, **options) == sorted(changed)
    back = spark.read.parquet(path)
    assert [r.text for r in back.where("shard = 77").collect()] == ["kept"]
    key = lambda x: tuple(str(v) for v in x)
    got = sorted(((r.doc_id, zlib.crc32((r.text or "").encode()), r.shard) for r in back.where("shard <> 77").collect()), key=key)
    assert got == sorted(((r.doc_id, r.text_crc32, r.shard) for r in plan if r.shard in changed), key=key)
    assert sharding.rewrite_shards(docs.limit(0), path, **options) == []


def test_rewrite_removes_shards_that_end_empty(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * 10) for i in range(200)], "doc_id long, text string")
    path = str(tmp_path / "out")
    old = F.col("doc_id") % 6
    docs.withColumn("shard", old.cast("int")).write.partitionBy("shard").parquet(path)
    sharding.rewrite_shards(docs, path, old_shard=old, n_old=6, n_new=3, blocks=8)
    back = spark.read.parquet(path)
    assert sorted(r.doc_id for r in back.collect()) == list(range(200)) and {r.shard for r in back.collect()} == {0, 1, 2}


def test_reshard_carries_rows(docs, rows, empty):
    got = sharding.reshard(docs)
    assert set(got.columns) == {*docs.columns, "size", "text_crc32", "old_shard", "shard", "slot"}
    found, plan = got.collect(), sharding.reshard_plan(docs).collect()
    key = lambda r: (str(r.doc_id), r["size"], r.text_crc32, r.old_shard, r.shard, r.slot)
    assert sorted(map(key, found)) == sorted(map(key, plan))
    assert sorted(str(r.text) for r in found) == sorted(str(t) for _, t, _ in rows) and {r.node for r in found} == {"a"}
    assert sharding.reshard(empty).count() == 0


def brute_flow(supply, capacity):
    """The least cost of shipping whole units, by trying every way."""
    if not any(supply):
        return 0
    o = next(k for k, x in enumerate(supply) if x)
    best = float("inf")
    for s, room in enumerate(capacity):
        if room:
            rest = [x - (k == o) for k, x in enumerate(supply)], [x - (k == s) for k, x in enumerate(capacity)]
            best = min(best, (o != s) + brute_flow(*rest))
    return best


def test_flow_against_every_way():
    r = random.Random(2)
    for _ in range(40):
        supply, capacity = [r.randint(0, 2) for _ in range(3)], [r.randint(0, 3) for _ in range(3)]
        if sum(capacity) < sum(supply):
            continue
        flow = sharding.min_cost_flow(supply, capacity, lambda o, s: int(o != s))
        assert sum(n for (o, s), n in flow.items() if o != s) == brute_flow(supply, capacity)
        assert all(sum(n for (o, _), n in flow.items() if o == k) == x for k, x in enumerate(supply))
        assert all(sum(n for (_, s), n in flow.items() if s == k) <= x for k, x in enumerate(capacity))


def test_stages_keep_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(30))
    names = ["rows", "least", "row", "copies", "_rows", "_copies", "nth", "key", "kept", "size", "_id", "d.w"]
    rows = [(i, text if i < 3 else f"{i} " * (i + 6), "s", *["v"] * len(names)) for i in range(8)] + [(None, text, None, *["v"] * len(names))]
    wide = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    kept = jaccard.keep_one(wide)
    assert kept.columns == wide.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["0", "3", "4", "5", "6", "7", "None"]
    mixed = mixing.mix(wide)
    assert mixed.columns == wide.columns and mixed.count() == sum(r.copies for r in mixing.mix_plan(wide).collect())
    assert sharding.reshard(wide).where("`d.w` = 'v'").count() == len(rows)


def brute_repeats(rows, length=100):
    seen, out = {}, []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t, _ in order:
        raw = (t or "").encode()
        for p in range(len(raw) - length + 1):
            seen.setdefault(raw[p : p + length], (i is not None, i or 0, p))
    for i, t, _ in order:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if seen[raw[p : p + length]] < (i is not None, i or 0, p):
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_substrings(docs, rows, empty):
    got = substrings.remove_repeats(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(brute_repeats(rows), key=key)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)
    assert substrings.remove_repeats(empty).count() == 0


def test_html_exact_on_made_up_pages(spark):
    made = [htmltext.made_up_page(50_000 + k) for k in range(120)]
    pages = spark.createDataFrame([(k, f"u{k}", s) for k, (s, _) in enumerate(made)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r for r in htmltext.extract(pages).collect()}
    right = sum(got[k].text == "\n".join(w) for k, (_, w) in enumerate(made))
    assert right >= 114 and all(r.n_chars == len(r.text) for r in got.values())


def test_html_odd_pages(spark):
    odd = [None, "", "plain", "<", "<p", "<!--", "<article><p>A &amp; B<p>C\n D</article><script>x", "<div" * 5000, '<p class="x>y', "<article>" + "<div>" * 3000 + "deep"]
    pages = spark.createDataFrame([(k, None, s) for k, s in enumerate(odd)] + [(None, None, None)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmltext.extract(pages).collect()}
    assert len(got) == 11 and got[0] == "" and got[6] == "A & B\nC D"


def brute_hits(text, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w = cut(text)
    hit, found = set(), set()
    for item, t in items:
        v = cut(t)
        windows = {tuple(v[k : k + 13]) for k in range(len(v) - 12)} if len(v) >= 13 else {tuple(v)} - {()}
        for x in windows:
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    found.add(str(item) if item is not None else "")
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [32_000_000, 50])
def test_decontamination(spark, docs, rows, empty, monkeypatch, block):
    monkeypatch.setattr(decontam, "AUTOMATON_BYTES", block)
    items = [(1, rows[4][1]), (2, rows[9][1]), (10, "Ab,ab"), (3, None), (4, " .. "), (None, rows[20][1]), (1, rows[30][1]), (5, "straße Ünï")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.benchmark_hits(docs, bench).collect()
    want = sorted((i is None, i or 0, *brute_hits(t, items)) for i, t, _ in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r.item_ids) for r in got) == want
    clean = sum(not (h and 20 * h >= n) for _, _, n, h, _ in want)
    assert decontam.decontaminate(docs, bench).count() == clean
    assert decontam.benchmark_hits(empty, bench).count() == 0 and decontam.benchmark_hits(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_decontamination_offsets(spark):
    docs = spark.createDataFrame([(1, "Ça? THE big—Cat, sat. End")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "the BIG")], "item_id long, text string")
    found = decontam.benchmark_hits(docs, bench).first()
    assert found.n_hit == 0  # the dash belongs to a word here
    found = decontam.benchmark_hits(docs, spark.createDataFrame([(7, "cat sat"), (8, "sat end")], "item_id long, text string")).first()
    assert [docs.first().text[s.start : s.end] for s in found.spans] == ["sat. End"] or found.n_hit >= 2


def test_licenses(spark, docs, empty):
    text = licenses.TEMPLATES["ISC"].replace("modify", "change").replace("purpose ", "purpose whatsoever ")
    rows = [(1, "Ünï words. " + text + " after"), (2, "released under the MIT license"), (3, "nothing here"), (4, None), (5, ""), (None, "Licensed under CC BY-NC 4.0.")]
    got = licenses.scan_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license) for r in got} == {(1, "ISC"), (2, "MIT-notice"), (None, "CC-BY-NC-4.0-notice")}
    isc = next(r for r in got if r.license == "ISC")
    assert 0.9 < isc.coverage < 1 and rows[0][1][isc.start : isc.end].startswith("Permission") and rows[0][1][isc.start : isc.end].endswith("copies")
    assert licenses.scan_documents(empty).count() == 0


@pytest.mark.parametrize("name", ["MIT", "Apache-2.0-header", "BSD-2-Clause"])
def test_licenses_with_ten_words_more_or_less(name):
    index, words = licenses.build_index(licenses.TEMPLATES), licenses.TEMPLATES[name].split()
    half = len(words) // 2
    for text, least in ((words[:half] + [f"new{i}" for i in range(10)] + words[half:], 1), (words[:half] + words[half + 10 :], 0.85)):
        text = " ".join(text)
        ((found, share, start, end),) = licenses.scan(index, f"Before it, words. {text} And after.")
        assert (found, start) == (name, 18) and least <= share <= 1 and 18 + len(text) - end <= 1


def test_licenses_every_template():
    index = licenses.build_index(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        assert [x[:2] for x in licenses.scan(index, f"Some words. {text} And more of them.")] == [(name, 1.0)]
    assert [x[0] for x in licenses.scan(index, f"{licenses.TEMPLATES['BSD-3-Clause']} {licenses.TEMPLATES['BSD-disclaimer']}")] == ["BSD-3-Clause", "BSD-disclaimer"]
    r = random.Random(4)
    for _ in range(50):  # whatever the hashes of the words around it
        words = ["".join(r.choices("abcdefgh", k=4)) for _ in range(8)]
        assert [x[0] for x in licenses.scan(index, " ".join([*words[:4], "All rights reserved.", *words[4:]]))] == ["All-rights-reserved"]


def test_license_alignments_have_the_best_score():
    r = random.Random(3)
    for _ in range(200):
        template, words = (np.array(r.choices(range(6), k=k), np.uint64) for k in (r.randint(1, 6), r.randint(1, 25)))
        best = {}
        for i, t in enumerate(template):
            for j in np.flatnonzero(words == t).tolist():
                best[i, j] = licenses.SKIP + max([0, *(v - (j - b - 1) for (a, b), v in best.items() if a < i and b < j)])
        got = licenses.align(template, words, 0)
        assert bool(got) == bool(best)
        if got:
            count, first, last = got[0]
            assert (licenses.SKIP + 1) * count - (last - first + 1) == max(best.values())


def water_fill(sizes, weights, share, most):
    budget, target, open_ = share * sum(sizes.values()), {}, dict(zip(sizes, weights))
    while open_:
        level = budget / sum(open_.values())
        full = [s for s in open_ if level * open_[s] > most * sizes[s]]
        if not full:
            return target | {s: level * w for s, w in open_.items()}
        for s in full:
            target[s] = most * sizes[s]
            budget -= target[s]
            del open_[s]
    return target


def test_mixing(docs, rows, empty):
    plan = mixing.mix_plan(docs).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    sizes = {s: sizes[s] for s in order}
    want = water_fill(sizes, [(3, 1, 2)[k % 3] for k in range(len(order))], 1.5, 2)
    for r in plan:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] and 0 <= r.copies <= 2
    assert sorted(map(tuple, plan), key=str) == sorted(map(tuple, mixing.mix_plan(docs.repartition(3)).collect()), key=str)
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == sum(r.copies for r in plan) and mixing.mix_plan(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mixing_comes_near_its_targets(spark):
    r = random.Random(5)
    docs = table(spark, [(i, "w " * int(r.paretovariate(1.2) * 10 % 3000), r.choice("aaaabc")) for i in range(4000)])
    for x in mixing.mix_plan(docs).groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("copies") * F.col("size")).alias("taken")).collect():
        assert x.taken == pytest.approx(x.target, rel=0.03)
