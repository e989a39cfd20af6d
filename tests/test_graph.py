"""Writes, patterns, introspection and validation on a small graph of gadgets."""

import pytest
from pyspark.sql import functions as F

from lattica.operators import introspect, pattern, validate, write
from lattica.operators.graph import NODE_KEY, Graph

NODES = "universe string, key_label string, id string, leaf string, labels array<string>, name string, props struct<weight:double,serial:long,note:string>"
EDGES = "universe string, type string, src_label string, src_id string, dst_label string, dst_id string, props struct<strength:string,slot:int>"
ABOVE = {"Widget": ["Gadget"], "Gizmo": ["Gadget"], "Gadget": [], "Color": []}
ONTOLOGY = list(ABOVE)


def node(leaf, id_, **props):
    return ("toy", leaf, id_, leaf, [leaf, *ABOVE[leaf]], id_.title(), (props.get("weight"), props.get("serial"), props.get("note")))


def edge(type_, a, b, **props):
    return ("toy", type_, *a, *b, (props.get("strength"), props.get("slot")))


@pytest.fixture
def make(spark):
    return lambda nodes, edges=(): Graph(spark.createDataFrame(list(nodes), NODES), spark.createDataFrame(list(edges), EDGES))


ALPHA, BETA, RED, BLUE = ("Gadget", "alpha"), ("Gadget", "beta"), ("Color", "red"), ("Color", "blue")


@pytest.fixture
def toy(make):
    nodes = [node("Gadget", "alpha", weight=1.5, serial=7), node("Gadget", "beta"), node("Color", "red"), node("Color", "blue"), node("Widget", "w1", serial=1)]
    return make(nodes, [edge("HAS_COLOR", ALPHA, RED), edge("HAS_COLOR", ALPHA, BLUE), edge("PAIRS", ALPHA, BETA, strength="a"), edge("PAIRS", BETA, ("Widget", "w1"))])


def ids(df):
    return sorted(r.id for r in df.collect())


def ends(df):
    return sorted((r.src_id, r.dst_id) for r in df.collect())


def test_upsert_merges_and_sync_replaces(toy, make):
    batch = make([node("Gadget", "alpha", serial=9)]).nodes
    merged = {r.id: r.props for r in write.merge_nodes(toy.nodes, batch, ONTOLOGY).collect()}
    assert (merged["alpha"].weight, merged["alpha"].serial) == (1.5, 9)
    replaced = {r.id: r.props for r in write.merge_nodes(toy.nodes, batch, ONTOLOGY, replace=True).collect()}
    assert (replaced["alpha"].weight, replaced["alpha"].serial) == (None, 9)


def test_reference_by_ancestor_finds_subclass_but_not_the_reverse(toy, make):
    stub = make([node("Gadget", "w1")]).nodes
    assert ids(write.insert_stubs(toy.nodes, stub)) == ids(toy.nodes)
    owner = make([node("Widget", "beta")]).nodes
    assert ids(write.merge_nodes(toy.nodes, owner, ONTOLOGY)).count("beta") == 2


def test_labels_outside_the_ontology_stay(toy, make):
    tagged = Graph(toy.nodes.withColumn("labels", F.concat("labels", F.array(F.lit("Tagged")))), toy.edges)
    got = {r.id: r.labels for r in write.merge_nodes(tagged.nodes, make([node("Gadget", "alpha")]).nodes, ONTOLOGY).collect()}
    assert sorted(got["alpha"]) == ["Gadget", "Tagged"]


def test_edges_merge_by_ends_and_vanish_without_them(toy, make):
    batch = make([], [edge("PAIRS", ALPHA, BETA, slot=3), edge("PAIRS", ALPHA, ("Gadget", "w1")), edge("PAIRS", ALPHA, ("Gadget", "nobody"))]).edges
    got = {(r.src_id, r.dst_label, r.dst_id): r.props for r in write.merge_edges(toy, batch).where("type = 'PAIRS'").collect()}
    assert got["alpha", "Gadget", "beta"].asDict() == {"strength": "a", "slot": 3}
    assert ("alpha", "Widget", "w1") in got and len(got) == 3
    assert write.merge_edges(toy, batch, replace=True).where("dst_id = 'beta'").first().props.strength is None


def claims(spark, anchor, type_, other=None, owns=False):
    return spark.createDataFrame([("toy", *anchor, type_, other, owns)], "universe string, anchor_label string, anchor_id string, type string, other_label string, owns_other_end boolean")


def kept(spark, rows):
    return spark.createDataFrame(rows, "universe string, type string, anchor_label string, anchor_id string, other_label string, other_id string")


def test_claim_drops_edges_and_keeps_nodes(spark, toy):
    got = write.prune_claims(toy, claims(spark, ALPHA, "HAS_COLOR"), kept(spark, [("toy", "HAS_COLOR", *ALPHA, *RED)]), toy.nodes.limit(0), "out")
    assert ends(got.edges.where("type = 'HAS_COLOR'")) == [("alpha", "red")] and len(ids(got.nodes)) == 5


def test_owned_end_goes_unless_listed(spark, toy):
    claim = claims(spark, ALPHA, "HAS_COLOR", "Color", True)
    gone = write.prune_claims(toy, claim, kept(spark, [("toy", "HAS_COLOR", *ALPHA, *RED)]), toy.nodes.limit(0), "out")
    assert "blue" not in ids(gone.nodes)
    stays = write.prune_claims(toy, claim, kept(spark, [("toy", "HAS_COLOR", *ALPHA, *RED)]), toy.nodes.where("id = 'blue'"), "out")
    assert "blue" in ids(stays.nodes) and ("alpha", "blue") not in ends(stays.edges)


def test_upsert_twice_changes_nothing(toy, make):
    batch = make([node("Gadget", "alpha", serial=1), node("Color", "green")], [edge("HAS_COLOR", BETA, RED)])
    once = write.upsert(toy, batch.nodes, batch.edges, batch.nodes.limit(0), ONTOLOGY)
    twice = write.upsert(once, batch.nodes, batch.edges, batch.nodes.limit(0), ONTOLOGY)
    assert write.counters(once.nodes, twice.nodes, NODE_KEY).first().asDict() == {"created": 0, "deleted": 0, "kept": 6}
    assert sorted(map(str, once.edges.collect())) == sorted(map(str, twice.edges.collect()))


def test_sync_mirrors_its_scope(toy, make):
    batch = make([node("Color", "red")], [])
    got = write.sync(toy, batch.nodes, batch.edges, ["Color"], ONTOLOGY)
    assert ids(got.nodes) == ["alpha", "beta", "red", "w1"] and ("alpha", "blue") not in ends(got.edges)


def test_purge(toy):
    assert write.purge(toy, "toy").nodes.count() == 0 and write.purge(toy, "other").edges.count() == 4


def test_patterns(toy):
    start = pattern.scan(toy, "g", "Gadget")
    rows = pattern.expand(toy, start, "g", "HAS_COLOR", "c", optional=True)
    assert sorted((r.g.id, r.c.id if r.c else None) for r in rows.collect()) == [("alpha", "blue"), ("alpha", "red"), ("beta", None), ("w1", None)]
    assert sorted(r.g.id for r in pattern.without(toy, start, "g", "HAS_COLOR").collect()) == ["beta", "w1"]
    any_way = pattern.expand(toy, pattern.scan(toy, "b", ids=["beta"]), "b", "PAIRS", "o", direction="any", edge="e")
    assert sorted((r.o.id, r.e.forward) for r in any_way.collect()) == [("alpha", False), ("w1", True)]


def test_reach_ends_on_cycles(make):
    g = make([node("Color", c) for c in "abc"], [edge("NEXT", ("Color", a), ("Color", b)) for a, b in ("ab", "bc", "ca")])
    rows = pattern.reach(g, pattern.scan(g, "s", ids=["a"]), "s", ["NEXT"], "t", least=0).collect()
    assert [(r.t.id, r.depth) for r in sorted(rows, key=lambda r: r.depth)] == [("a", 0), ("b", 1), ("c", 2), ("a", 3)]


def test_introspection(toy):
    assert {r.label: r.n for r in introspect.count_labels(toy).collect()} == {"Gadget": 3, "Color": 2, "Widget": 1}
    assert {r.leaf: r.n for r in introspect.count_leaves(toy, ABOVE).collect()} == {"Gadget": 2, "Color": 2, "Widget": 1}
    shapes = {(r.leaf, r.property): r.mandatory for r in introspect.property_shapes(toy).collect()}
    assert shapes == {("Gadget", "weight"): False, ("Gadget", "serial"): False, ("Widget", "serial"): True}
    assert ids(introspect.stubs(toy)) == ["beta", "blue", "red"] and ids(introspect.orphans(toy)) == []
    assert introspect.fingerprint(toy).first() == introspect.fingerprint(Graph(toy.nodes.repartition(3), toy.edges)).first()


def test_gate(toy, make, spark):
    ontology = validate.Ontology(validate.transitive_ancestors(ABOVE), {"HAS_COLOR": frozenset(["Gadget"]), "PAIRS": frozenset()}, {"HAS_COLOR": frozenset(["Color"])})
    none = toy.nodes.limit(0)
    assert validate.gate(toy.nodes, toy.edges, none, ontology, none, None).count() == 0
    bad = make([node("Gadget", "x"), node("Widget", "x")], [edge("HAS_COLOR", RED, BLUE)])
    found = validate.gate(bad.nodes, bad.edges, none, ontology, none, None).collect()
    assert sorted((r.rule_id, r.id) for r in found) == [("ID", "x"), ("T1", "red")]
    odd = bad.nodes.withColumn("key_label", F.lit("Nothing"))
    assert {r.rule_id for r in validate.gate(odd, bad.edges, none, ontology, none, None).collect()} == {"IRI"}


def test_cycles_of_classes_end():
    assert validate.transitive_ancestors({"a": ["b"], "b": ["a", "c"]}) == {"a": frozenset("bc"), "b": frozenset("ac"), "c": frozenset()}
    above = {"HeldItem": frozenset(["Item"]), "Item": frozenset()}
    assert validate.key_class("HeldItem", above, frozenset(["Item"])) == "Item"
