"""Names, wiki text, sources, name lookup and evaluation."""

import hashlib
import json
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from lattica.functions import naming, wikitext
from lattica.operators import compare, resolve
from lattica.operators.graph import Graph
from lattica.plans.catalogue import QUERIES
from lattica.sources import tables, turtle
from lattica.streaming.ingest import event_counts, ingest_nodes
from tests.test_graph import EDGES, NODES, node


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("name, slug", [("Béta Unit", "beta-unit"), ("Farfetch'd", "farfetchd"), ("  Mr. Mime ", "mr-mime"), ("ﬁn ½", "fin-1-2"), ("♀", "")])
def test_slugs(spark, name, slug):
    assert one(spark, name, naming.node_id) == slug


def test_slugs_of_whole_texts(spark, tmp_path):
    texts = ["Über alle Maßen: " + "ein langer Satz, " * 20 + "ﬁn ½ x² d’été", "It's\nA\tB", "", "…", None]
    rows = [(i, t, lang) for i, t in enumerate(texts) for lang in ("de", "en", None, "xx")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))

    def slug(text):
        plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
        return "-".join(re.findall("[a-z0-9]+", plain.replace("'", "").replace("’", "").lower()))

    got = QUERIES["slug_ids"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, None if t is None else slug(t)) for i, t, _ in rows), key=str)


def test_names(spark):
    assert one(spark, "Nidoran♀", naming.species_id) == "nidoran-f"
    assert one(spark, "hasSecondaryType", naming.relationship_type) == "HAS_SECONDARY_TYPE"
    assert one(spark, "http://x/y#hasColor", naming.local_name) == "hasColor"
    assert one(spark, "main_page#top", naming.normalize_title) == "Main page"
    assert one(spark, "#REDIRECT [[pallet town|x]]", naming.redirect_target) == "Pallet town"
    assert [one(spark, x, naming.read_roman) for x in ("IX", "XXXIX", "IIII", "", "XIV")] == [9, 39, None, None, 14]
    span = one(spark, "Generation II-V", naming.generation_span)
    assert (span.first, span.last) == (2, 5)
    open_ = one(spark, "Generation VI onward", naming.generation_span)
    assert (open_.first, open_.last) == (6, None) and one(spark, "Other", naming.generation_span) is None
    codes = one(spark, "RGBYX", lambda c: naming.game_codes(c, ["R", "G", "B", "BY"]))
    assert (codes.codes, codes.rest) == (["R", "G", "BY"], "X")
    digest = hashlib.sha1(b"x").hexdigest()
    n, coded = int(digest, 16), ""
    while n:
        n, k = divmod(n, 36)
        coded = "0123456789abcdefghijklmnopqrstuvwxyz"[k] + coded
    assert one(spark, coded, naming.hex_of_base36) == digest


PAGE = "Lead {{tt|Text|note}}.\n== A ==\none [[b|two]]<ref>x</ref>\n=== B ===\n* dot <!-- == no == -->\n== C ==\n{{Info|name=X|name=Y|{{in|1}}}}"


def test_wikitext(spark):
    got = one(spark, PAGE, wikitext.sections)
    assert [(s.level, s.title, s.path) for s in got] == [(0, "", []), (2, "A", ["A"]), (3, "B", ["A", "B"]), (2, "C", ["C"])]
    assert one(spark, "one [[b|two]] '''three'''<ref>x</ref> {{t|a|b}}<br>z", wikitext.plain) == "one two three b\nz"
    found = one(spark, PAGE, wikitext.templates)
    assert [t.name for t in found] == ["tt", "info"] and found[1].params == {"name": "Y", "1": "{{in|1}}"}
    assert wikitext.split_top_level("a|{{b|c}}|[[d|e]]|f") == ["a", "{{b|c}}", "[[d|e]]", "f"]
    assert wikitext.categories("[[Category:B|x]] [[category: A]]") == ["A", "B"]


def test_short_paragraphs(spark):
    long = "x" * 120
    for texts in (["a", long, "b"], ["a", "b"], [long], [], [long, "a", "b", long, "c"]):
        want = [t for _, t in wikitext.merge_short([("paragraph", t) for t in texts])]
        got = spark.createDataFrame([(texts,)], "x array<string>").select(wikitext.merge_short_column(F.col("x")).alias("y")).first().y
        assert got == want


def test_turtle():
    text = '@prefix : <http://x/> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> .\n:a a :C ; :p "x"@en, "1.5"^^xsd:decimal , 7 , true ; :q [ :r ( :b :c ) ] . # end'
    triples = turtle.read_turtle(text)
    said = {(s.value, p.value.rpartition("/")[2].rpartition("#")[2], o.value, o.datatype and o.datatype.rpartition("#")[2], o.language) for s, p, o in triples}
    assert {("http://x/a", "type", "http://x/C", None, None), ("http://x/a", "p", "x", None, "en"), ("http://x/a", "p", "1.5", "decimal", None), ("http://x/a", "p", "7", "integer", None), ("http://x/a", "p", "true", "boolean", None)} <= said
    assert sum(p.value.endswith("#first") for _, p, _ in triples) == 2
    with pytest.raises(ValueError):
        turtle.read_turtle(":a :b .")


def test_pinned_csv_and_pages(spark, tmp_path):
    path = tmp_path / "moves.csv"
    path.write_text('id,identifier\n1,"a,b"\n2,\n')
    digest = hashlib.sha256(path.read_bytes()).hexdigest()
    assert [tuple(r) for r in tables.read_pinned_csv(spark, str(path), digest).collect()] == [("1", "a,b"), ("2", None)]
    with pytest.raises(tables.ChangedSource):
        tables.read_pinned_csv(spark, str(path), "0" * 64)
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    pages = [{"title": t, "page_id": k, "revision_id": 1, "sha1": sha(t), "page_type": "x", "wikitext": w} for k, (t, w) in enumerate([("a", "a"), ("b", "changed"), ("c", "c")])]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, pages)))
    found = tables.read_pages(spark, str(tmp_path / "p.json"))
    pins = spark.createDataFrame([(0, 1, sha("a")), (1, 1, sha("b")), (9, 1, "")], "page_id long, revision_id long, sha1 string")
    assert {r.page_id: r.problem for r in tables.page_mismatch(found, pins).collect()} == {1: "content hash", 9: "missing"}
    assert [r.page_id for r in tables.unpinned_pages(found, pins).collect()] == [2]


def test_snapshots_and_stream(spark, tmp_path):
    root = str(tmp_path / "graph")
    nodes = spark.createDataFrame([node("Gadget", "alpha", serial=1)], NODES)
    first = tables.commit_graph(spark, Graph(nodes, spark.createDataFrame([], EDGES)), root)
    more = spark.createDataFrame([node("Gadget", "alpha", weight=2.0), node("Color", "red")], NODES)
    more.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(more.schema).parquet(str(tmp_path / "in"))
    ingest_nodes(stream, root, ["Gadget", "Color"], str(tmp_path / "check")).awaitTermination()
    got = {r.id: r.props for r in tables.read_graph(spark, root).nodes.collect()}
    assert set(got) == {"alpha", "red"} and (got["alpha"].serial, got["alpha"].weight) == (1, 2.0)
    assert tables.read_graph(spark, root, first).nodes.count() == 1
    with pytest.raises(tables.StaleSnapshot):
        tables.commit_graph(spark, Graph(nodes, spark.createDataFrame([], EDGES)), root, after=first)
    now = tables.current_version(spark, root)
    more.union(more).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    ingest_nodes(stream, root, ["Gadget", "Color"], str(tmp_path / "check")).awaitTermination()
    assert tables.current_version(spark, root) == now and {r.id for r in spark.read.parquet(root + "/refused").collect()} == {"alpha", "red"}


def test_event_windows(spark):
    events = spark.sql("select timestamp'2024-01-01 10:59:00' ts, 'a' event_type, 1.0 value union all select timestamp'2024-01-01 11:00:00', 'a', 2.0")
    assert event_counts(events).count() == 2


def test_name_lookup(spark):
    nodes = spark.createDataFrame([node("Gadget", n) for n in ("pikachu", "raichu", "mew", "mewtwo")], NODES)
    asked = spark.createDataFrame([(0, "Pikchu", "Gadget"), (1, "mew", None), (2, "nothing like it", None)], "position int, mention string, label string")
    got = {(r.position, r.rank): r.id for r in resolve.look_up(asked, nodes).collect()}
    assert got[0, 1] == "pikachu" and got[1, 1] == "mew" and not [k for k in got if k[0] == 2]


def test_aliases_and_the_score_floor(spark):
    kind = "universe string, key_label string, id string, leaf string, labels array<string>, name string, props struct<aliases:array<string>>"
    rows = [("t", "G", f"n{i}", "G", ["G"], f"name{i}", ([f"other{i}", "shared"],)) for i in range(60)]
    nodes = spark.createDataFrame(rows, kind)
    asked = spark.createDataFrame([(0, "other7", None), (1, "name7", None), (2, "shared", None)], "position int, mention string, label string")
    got = {(r.position, r.rank): (r.id, r.score) for r in resolve.look_up(asked, nodes).collect()}
    assert got[0, 1][0] == "n7" and got[1, 1][0] == "n7" and got[1, 1][1] > got[0, 1][1]
    floored = resolve.look_up(asked, nodes, resolve.SCORE_FLOOR).collect()
    assert floored and all(r.score >= resolve.SCORE_FLOOR and r.position == 1 for r in floored)


def test_precision_and_recall_of_nothing(spark):
    rows = lambda *x: spark.createDataFrame(list(x), "question int, node string")
    asked = spark.createDataFrame([(1,), (2,), (3,), (4,)], "question int")
    got = {r.question: (r.precision, r.recall) for r in compare.precision_recall(rows((1, "a"), (1, "b"), (3, "x")), rows((1, "a"), (2, "a")), asked).collect()}
    assert got == {1: (0.5, 1.0), 2: (0.0, 0.0), 3: (0.0, 1.0), 4: (1.0, 1.0)}


def test_questions(spark):
    text = '[[questions]]\nid = "q1"\nquestion = "?"\n[[questions]]\nid = "q2"\nquestion = "!"\n'
    assert tables.questions(spark, {"s": text}).count() == 2
    with pytest.raises(ValueError):
        tables.questions(spark, {"s": text, "t": text})
