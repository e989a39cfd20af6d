"""Whole batches, checks of batches, sweeps, schema cache; ontologies and individuals from Turtle."""

import pytest
from pyspark.sql import functions as F

from lattica.functions import wikitext
from lattica.operators import evidence, introspect, runner, sequence, write
from lattica.operators.graph import Graph
from lattica.sources import ontology, tables, turtle
from tests.test_graph import ABOVE, ALPHA, BETA, BLUE, EDGES, NODES, ONTOLOGY, RED, edge, ends, ids, make, node, toy  # noqa: F401


def claims(spark, *rows):
    return spark.createDataFrame([("toy", *r) for r in rows], runner.CLAIM)


def test_claims_drop_edges_and_owned_ends(spark, toy, make):  # noqa: F811
    b = make([node("Gadget", "alpha", serial=8)], [edge("HAS_COLOR", ALPHA, RED)])
    after, said = runner.write_batch(toy, runner.batch(b.nodes, b.edges, make([node("Color", "red")]).nodes, claims(spark, (*ALPHA, "HAS_COLOR", "out", "Color", True))), "toy", ONTOLOGY)
    assert ("alpha", "blue") not in ends(after.edges) and ("alpha", "red") in ends(after.edges) and "blue" not in ids(after.nodes)
    assert said.first().asDict() == {"nodes_created": 0, "nodes_deleted": 1, "nodes_kept": 4, "edges_created": 0, "edges_deleted": 1, "edges_kept": 3}
    again, said = runner.write_batch(after, runner.batch(b.nodes, b.edges), "toy", ONTOLOGY)
    total = runner.add_reports([said, said]).first()
    assert (total.nodes_created, total.nodes_deleted, total.edges_created, total.edges_deleted) == (0, 0, 0, 0)


def test_batches_that_are_refused(spark, toy, make):  # noqa: F811
    b = make([node("Gadget", "alpha")])
    one = claims(spark, (*ALPHA, "HAS_COLOR", "out", None, False))
    for bad in (lambda: runner.write_batch(toy, runner.batch(b.nodes, b.edges), "other", ONTOLOGY), lambda: runner.write_batch(toy, runner.batch(b.nodes, b.edges, b.nodes), "toy", ONTOLOGY, "sync"), lambda: runner.write_batch(toy, runner.batch(b.nodes, b.edges, None, one), "toy", ONTOLOGY, "sync"), lambda: runner.write_batch(toy, runner.batch(b.nodes, b.edges), "toy", ONTOLOGY, "replace")):
        with pytest.raises(runner.RejectedBatch):
            bad()
    twice = make([node("Gadget", "alpha"), node("Gadget", "alpha")]).nodes
    with pytest.raises(Exception, match="a batch repeats"):
        write.merge_nodes(toy.nodes, twice, ONTOLOGY).collect()


def test_sync_mirrors_the_batch(toy, make):  # noqa: F811
    b = make([node("Gadget", "alpha", serial=8), node("Color", "red")], [edge("HAS_COLOR", ALPHA, RED)])
    after, said = runner.write_batch(toy, runner.batch(b.nodes, b.edges), "toy", ONTOLOGY, "sync", ["Gadget", "Color"])
    assert ids(after.nodes) == ["alpha", "red"] and ends(after.edges) == [("alpha", "red")] and said.first().nodes_deleted == 3


def test_check_batch(spark, make):  # noqa: F811
    b = make([node("Gadget", "alpha"), node("Gadget", "alpha"), node("Color", "red")], [edge("HAS_COLOR", ALPHA, RED), edge("HAS_COLOR", ALPHA, RED), edge("PAIRS", ALPHA, BETA)])
    bad = runner.batch(b.nodes, b.edges, make([node("Color", "blue", note="x")]).nodes, claims(spark, (*ALPHA, "HAS_COLOR", "out", "Color", True), (*ALPHA, "HAS_COLOR", "out", "Color", True), (*BETA, "PAIRS", "in", None, False)))
    assert sorted({(r.rule_id, r.id) for r in runner.check_batch(bad, ["Gadget"]).collect()}) == [("BA", "beta"), ("BC", "alpha"), ("BE", "alpha"), ("BN", "alpha"), ("BO", "alpha"), ("BS", "blue"), ("BX", "alpha")]
    assert runner.check_batch(runner.batch(b.nodes.limit(0), b.edges.limit(0))).count() == 0
    assert [(r.id, r.class_label) for r in runner.unique_ids(b.nodes, ["Gadget"]).collect()] == [("alpha", "Gadget")]


def test_schema_cache(toy, tmp_path):  # noqa: F811
    path = str(tmp_path / "schema")
    first, status = introspect.cached_schema(toy, ABOVE, path)
    assert status == "MISSING" and introspect.cached_schema(toy, ABOVE, path)[1] == "HIT"
    rows = {(r.part, r.name): (r.detail, r.n) for r in first.collect()}
    assert rows["leaf", "Gadget"] == ("", 2) and rows["type property", "PAIRS.strength"] == ("string?", 1) and rows["pattern", "Gadget-HAS_COLOR->Color"] == ("", 2)
    assert introspect.cached_schema(Graph(toy.nodes.where("id <> 'red'"), toy.edges), ABOVE, path)[1] == "STALE"
    assert introspect.cached_schema(toy, ABOVE, path, refresh=True)[1] == "REFRESHED"
    toy.nodes.select("id").write.mode("overwrite").parquet(path)
    assert introspect.cached_schema(toy, ABOVE, path)[1] == "INVALID"


def test_results_of_other_universes(spark):
    rows = spark.createDataFrame([(1, ("a", ["Toy", "X"])), (2, ("b", ["Y"])), (3, None)], "n int, v struct<id:string,labels:array<string>>")
    assert [r.n for r in introspect.foreign_rows(rows, "v", ["Toy"]).collect()] == [2]
    lists = spark.createDataFrame([(["a", "b", "c"],), (["a"],)], "x array<string>")
    assert [r[0] for r in lists.select(introspect.shown(F.col("x"), 2)).collect()] == ["a, b and 1 more", "a"]
    assert spark.range(1).select(introspect.plain_type(F.lit("STRING NOT NULL"))).first()[0] == "STRING"


def test_sequences(spark):
    rows = spark.createDataFrame([("s", "a", 2, "two"), ("s", "a", 1, "one"), ("s", "k", 3, "text"), ("t", "a", 1, "one")], "subject string, aspect string, seq int, text string")
    got = {(r.subject, r.text): r.key for r in sequence.number_chunks(rows, ["k"]).collect()}
    assert (got["s", "one"], got["s", "two"], got["t", "one"], len(got["s", "text"])) == ("1", "2", "1", 8)
    assert sequence.key_collisions(sequence.number_chunks(rows, ["k"])).count() == 0
    spans = spark.createDataFrame([("a", 1, 1, 5), ("a", 2, 6, None), ("a", 3, None, None), ("b", 4, None, None), ("b", 5, 1, 3), ("c", 6, 1, 2), ("c", 7, 1, 4)], "g string, id int, first int, last int")
    assert {r.g: r.id for r in sequence.pick_span(spans, ["g"], "id", 9).collect()} == {"a": 2, "b": 4, "c": 7}


TTL = """@prefix : <http://x/t#> . @prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> . @prefix owl: <http://www.w3.org/2002/07/owl#> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
:Thing a owl:Class . :Gadget a owl:Class ; rdfs:subClassOf :Thing . :Widget a owl:Class ; rdfs:subClassOf :Gadget . :Color a owl:Class ; rdfs:subClassOf :Thing .
:A a owl:Class ; rdfs:subClassOf :B . :B a owl:Class ; rdfs:subClassOf :A .
:linked a owl:ObjectProperty ; rdfs:domain [ owl:unionOf ( :Gadget :Color ) ] ; rdfs:range :Thing .
:hasColor a owl:ObjectProperty ; rdfs:subPropertyOf :linked ; rdfs:range :Color .
:weight a owl:DatatypeProperty ; rdfs:domain :Gadget ; rdfs:range xsd:decimal . :nick a owl:DatatypeProperty ; rdfs:range xsd:string . :serial a owl:DatatypeProperty ; rdfs:range xsd:integer ."""
DATA = """@prefix : <http://x/t#> . @prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .
:alpha a :Widget ; rdfs:label "Alpha One"@en , "Alpha"@de ; :weight 1.5 ; :serial 7 ; :nick "b" , "a" ; :hasColor :red . :red a :Color ; rdfs:label "Red"@en ."""


def test_ontology_and_individuals(spark):
    m = ontology.model(turtle.read_turtle(TTL))
    iri = "http://x/t#"
    assert m.ancestors[iri + "Widget"] == {iri + "Gadget", iri + "Thing"} and m.ancestors[iri + "A"] == {iri + "B"}
    assert m.domains[iri + "hasColor"] == {iri + "Gadget", iri + "Color"} and m.ranges[iri + "hasColor"] == {iri + "Color"}
    assert m.datatypes[iri + "weight"].endswith("decimal") and m.labels(iri + "Widget") == ["Widget", "Gadget", "Thing"]
    assert m.key_label(iri + "Widget", [iri + "Gadget"]) == "Gadget" and m.key_label(iri + "Color", []) == "Color"
    with pytest.raises(ValueError):
        m.key_label(iri + "Widget", [iri + "Gadget", iri + "Thing"])
    slug = lambda t: t.lower().replace(" ", "-")
    found = ontology.individuals(turtle.read_turtle(DATA), m, slug)
    assert found.nodes[0] == (iri + "Widget", "alpha-one", "Alpha One", {iri + "weight": 1.5, iri + "serial": 7, iri + "nick": ["a", "b"]})
    assert found.edges == [(iri + "hasColor", (iri + "Widget", "alpha-one"), (iri + "Color", "red"))]
    nodes, edges = found.tables(spark, m, "toy")
    assert nodes.where("label = 'Widget'").first().labels == ["Widget", "Gadget", "Thing"] and edges.first().dst_id == "red"
    with pytest.raises(ontology.BadIndividuals) as e:
        ontology.individuals(turtle.read_turtle(DATA + ' :x a :Color ; :odd 1 . :y a :Color , :Widget ; rdfs:label "Y"@en ; :hasColor :none . :z a :Color ; rdfs:label "Red"@en .'), m, slug)
    assert len(str(e.value).split("\n")) == 5


def test_universes(tmp_path):
    home = tmp_path / "toys"
    home.mkdir()
    (home / "universe.toml").write_text('prefix = "toys"\ntitle = "Toys"\n[files]\nnotes = "notes.md"\n')
    with pytest.raises(ValueError, match="notes"):
        ontology.universes(tmp_path)
    (home / "notes.md").write_text("x")
    known = ontology.universes(tmp_path)
    assert ontology.select_universe(known).title == "Toys"
    with pytest.raises(ValueError):
        ontology.select_universe(known, "other")


def test_manifest_without_a_file_and_exports(spark, tmp_path):
    assert tables.manifest_pins(spark, str(tmp_path / "none.json")).count() == 0
    page = "<mediawiki><page><title>T</title><ns>0</ns><id>1</id>{}</page></mediawiki>"
    revision = "<revision><id>2</id><timestamp>2024-01-01T00:00:00Z</timestamp><text>x</text><sha1>1</sha1></revision>"
    (tmp_path / "one.xml").write_text(page.format(revision))
    (tmp_path / "two.xml").write_text(page.format(revision * 2))
    assert tables.read_export(spark, str(tmp_path / "one.xml")).first().wikitext == "x"
    with pytest.raises(Exception, match="one revision expected"):
        tables.read_export(spark, str(tmp_path / "two.xml")).collect()


def test_wiki_templates_within_templates():
    text = "a {{Box|x={{Dex|1|red}}|y={{dex|2}}}} <!-- {{dex|3}}\n== no ==\n--> <small>(only ''here'')</small>\n== B ==\nz"
    assert [wikitext.read_template(b)[1]["1"] for _, _, b in wikitext.find_templates(wikitext.mask_comments(text), ["dex"])] == ["1", "2"]
    assert len(wikitext.find_templates(wikitext.mask_comments(text))) == 1 and wikitext.mask_comments(text).count("\n") == text.count("\n")
    assert wikitext.small_captions(text) == ["only here"] and [s["title"] for s in wikitext.split_sections(text)] == ["", "B"]
    assert wikitext.captured_templates("p {{tt|a|b}} {{Dex|9}}", ["dex"]) == ("p b ", [("dex", {"1": "9"})])


def test_words_and_names():
    assert evidence.escape_word("a+b:c") == r"a\+b\:c"
    assert evidence.render_names([("x", [("L", "1", "X")]), ("y", [])]) == "x: X (L 1)\ny: nothing found"
