"""Shape rules on small batches: what each rule rejects, and that sound batches pass."""

import pytest

from lattica.operators import shapes
from lattica.operators.graph import Graph
from lattica.operators.validate import Ontology
from lattica.plans.creature_rules import SHAPES, SLOTS

PROPS = (
    "pokedexNumber int, femaleRate double, growthRate string, isGenderless boolean, pp int, priority int, target string, minHits int, maxHits int, minTurns int, maxTurns int,"
    "buyPrice int, flingPower int, machineKind string, machineNumber int, aspect string, source string, statStages int, effectText string, formKind string, isBattleOnly boolean,"
    "encounterKind string, minLevel int, maxLevel int, chance int, method string, isHidden boolean"
)
FIELDS = [f.split()[0] for f in PROPS.replace("\n", "").split(",")]
NODES = "universe string, key_label string, id string, leaf string, labels array<string>, name string, props struct<" + ",".join(":".join(f.split()) for f in PROPS.split(",")) + ">"
EDGES = "universe string, type string, src_label string, src_id string, dst_label string, dst_id string, props struct<slot:int,amount:int,potency:int,role:string,direction:string>"
CLASSES = "PokemonSpecies Type Nature Stat Flavor Move MoveDamageClass MoveFlag Generation BattleCondition Item Machine VersionGroup Version TextChunk LearnsetEntry MoveEffect Evolution FormChange Encounter ItemFind Location Ability Berry".split()
ONTOLOGY = Ontology({c: frozenset(["Entity", "Item"] if c in ("Machine", "Berry") else ["Entity"]) for c in CLASSES} | {"Entity": frozenset()})


def node(leaf, id_, **props):
    return ("u", leaf, id_, leaf, [leaf, "Entity"], id_, tuple(props.get(f) for f in FIELDS))


def edge(type_, src, dst, **props):
    return ("u", type_, *src, *dst, tuple(props.get(f) for f in ("slot", "amount", "potency", "role", "direction")))


def found(spark, nodes, edges=(), only=None):
    g = Graph(spark.createDataFrame(list(nodes), NODES), spark.createDataFrame(list(edges), EDGES))
    rules = [s for s in SHAPES if only is None or s.rule_id in only]
    facts, subjects = shapes.project(g, ONTOLOGY, SLOTS, shapes.inverse_paths(rules))
    return sorted({(r.rule_id, r.id) for r in shapes.run_shapes(facts, subjects, rules).collect()})


A, B = ("PokemonSpecies", "a"), ("PokemonSpecies", "b")
FIRE, WATER = ("Type", "fire"), ("Type", "water")


def test_species(spark):
    sound = node("PokemonSpecies", "a", pokedexNumber=1, femaleRate=0.5, growthRate="slow")
    edges = [edge("HAS_TYPE", A, FIRE, slot=1), edge("HAS_TYPE", A, WATER, slot=2), edge("YIELDS_EV", A, ("Stat", "hp"), amount=2)]
    types = [node("Type", "fire"), node("Type", "water")]
    assert found(spark, [sound, *types], edges, {"L2", "S1", "S2", "S3", "S4", "M1", "K1"}) == []
    bad = [node("PokemonSpecies", "a", pokedexNumber=0, femaleRate=0.5, isGenderless=True), node("PokemonSpecies", "b", femaleRate=2.0, growthRate="odd"), node("PokemonSpecies", "Not_Slug", pokedexNumber=3, isGenderless=True)]
    edges = [edge("HAS_TYPE", A, FIRE, slot=1), edge("HAS_TYPE", A, FIRE, slot=2), edge("HAS_TYPE", B, ("Move", "m"), slot=1), edge("YIELDS_EV", A, ("Stat", "hp"), amount=4), edge("YIELDS_EV", B, ("Stat", "hp"))]
    got = found(spark, [*bad, *types], edges, {"L2", "S1", "S2", "S3", "S4"})
    assert got == sorted([("L2", "Not_Slug"), ("S1", "a"), ("S1", "b"), ("S2", "a"), ("S2", "b"), ("S2", "Not_Slug"), ("S3", "a"), ("S3", "b"), ("S4", "a"), ("S4", "b")])


def test_natures_and_types(spark):
    n = lambda i: ("Nature", i)
    stat = lambda i: ("Stat", i)
    nodes = [node("Nature", i) for i in ("neutral", "good", "half", "same", "hp", "taste")] + [node("Type", "fire")]
    edges = [edge("BOOSTS_STAT", n("good"), stat("attack")), edge("REDUCES_STAT", n("good"), stat("speed")), edge("BOOSTS_STAT", n("half"), stat("attack"))]
    edges += [edge("BOOSTS_STAT", n("same"), stat("speed")), edge("REDUCES_STAT", n("same"), stat("speed")), edge("BOOSTS_STAT", n("hp"), stat("hp")), edge("REDUCES_STAT", n("hp"), stat("speed"))]
    edges += [edge("LIKES_FLAVOR", n("taste"), ("Flavor", "dry"))]
    edges += [edge("SUPER_EFFECTIVE_AGAINST", FIRE, WATER), edge("NO_EFFECT_AGAINST", FIRE, WATER), edge("NOT_VERY_EFFECTIVE_AGAINST", FIRE, FIRE)]
    assert found(spark, nodes, edges, {"N1", "N2", "K1"}) == [("K1", "fire"), ("N1", "half"), ("N1", "hp"), ("N1", "same"), ("N2", "taste")]


def test_moves_and_items(spark):
    ok = dict(pp=5, priority=0, target="self")
    nodes = [node("Move", "ok", **ok, minHits=2, maxHits=5), node("Move", "no-flag", **ok, minHits=2, maxHits=5), node("Move", "order", **ok, minHits=5, maxHits=2), node("Move", "half", **ok, minTurns=2), node("Move", "none")]
    edges = [edge("HAS_FLAG", ("Move", m), ("MoveFlag", "multihit")) for m in ("ok", "order")]
    for m in ("ok", "no-flag", "order", "half"):
        edges += [edge("INTRODUCED_IN", ("Move", m), ("Generation", "g1")), edge("HAS_TYPE", ("Move", m), FIRE), edge("HAS_DAMAGE_CLASS", ("Move", m), ("MoveDamageClass", "special"))]
    assert found(spark, nodes, edges, {"M1", "M2"}) == [("M1", "none"), ("M2", "half"), ("M2", "no-flag"), ("M2", "none"), ("M2", "order")]
    nodes = [node("Item", "ball", buyPrice=5), node("Item", "free", buyPrice=-1, flingPower=0), node("Machine", "tm-1", machineKind="TM", machineNumber=1), node("Machine", "xx-1", machineKind="XX", machineNumber=-1), node("Berry", "oran")]
    edges = [edge("INTRODUCED_IN", ("Item", "ball"), ("Generation", "g1")), edge("INTRODUCED_IN", ("Berry", "oran"), ("Generation", "g1")), edge("HAS_FLAVOR", ("Berry", "oran"), ("Flavor", "dry"), potency=0)]
    edges += [edge("IN_VERSION_GROUP", ("Machine", m), ("VersionGroup", "v")) for m in ("tm-1", "xx-1")] + [edge("TEACHES_MOVE", ("Machine", "tm-1"), ("Move", "ok"))]
    got = found(spark, nodes, edges, {"I1", "I2", "C2"})
    assert got == [("C2", "xx-1"), ("I1", "free"), ("I2", "oran")]


def test_texts_and_changes(spark):
    c = lambda i: ("TextChunk", i)
    nodes = [node("TextChunk", "page", aspect="trivia", source="p"), node("TextChunk", "dex", aspect="pokedex"), node("TextChunk", "both", aspect="flavor", source="p"), node("TextChunk", "wrong", aspect="flavor"), node("TextChunk", "odd", aspect="rumour", source="p")]
    edges = [edge("DESCRIBES", c(i), A) for i in ("page", "dex", "both", "wrong", "odd")]
    edges += [edge("FROM_WORK", c("dex"), ("Version", "red")), edge("FROM_WORK", c("both"), ("VersionGroup", "rb")), edge("FROM_WORK", c("wrong"), ("Version", "red"))]
    assert found(spark, nodes, edges, {"X1", "X2"}) == [("X1", "both"), ("X1", "odd"), ("X2", "wrong")]
    f = lambda i: ("FormChange", i)
    nodes = [node("FormChange", "mega", formKind="mega", isBattleOnly=True), node("FormChange", "alt", formKind="alternate", isBattleOnly=True), node("FormChange", "lost", formKind="mega", isBattleOnly=True), node("Location", "here"), node("Type", "fire", effectText="no")]
    edges = [edge(t, f(i), A) for t in ("FROM_SPECIES", "TO_SPECIES") for i in ("mega", "alt")]
    edges += [edge("REQUIRES", f("mega"), ("Item", "stone"), role="hold"), edge("REQUIRES", f("alt"), ("Move", "cut"), role="hold"), edge("ADJACENT_TO", ("Location", "here"), ("Location", "there"), direction="up")]
    assert found(spark, nodes, edges, {"V1", "V2", "R1", "C5", "X3"}) == [("C5", "here"), ("R1", "alt"), ("V1", "lost"), ("V2", "alt"), ("X3", "fire")]


def test_encounters_and_effects(spark):
    e = lambda i: ("Encounter", i)
    nodes = [node("Encounter", "ok", encounterKind="wild", minLevel=2, maxLevel=4, chance=10, method="surf"), node("Encounter", "bad", encounterKind="wild", minLevel=5, maxLevel=4, method="walk"), node("Encounter", "alone", encounterKind="gift")]
    edges = [edge("AT_LOCATION", e(i), ("Location", "here")) for i in ("ok", "bad", "alone")] + [edge("IN_VERSION", e(i), ("Version", "red")) for i in ("ok", "bad", "alone")]
    edges += [edge("HAS_ENCOUNTER", A, e("ok")), edge("HAS_ENCOUNTER", A, e("bad"))]
    assert found(spark, nodes, edges, {"C1", "C3"}) == [("C1", "alone"), ("C1", "bad"), ("C3", "bad")]
    nodes = [node("ItemFind", "x"), node("MoveEffect", "strong", statStages=7), node("BattleCondition", "rain", minTurns=5, maxTurns=8), node("BattleCondition", "snow", minTurns=5), node("Version", "red"), node("VersionGroup", "rb"), node("LearnsetEntry", "l")]
    edges = [edge("PART_OF", ("Version", "red"), ("VersionGroup", "rb")), edge("PART_OF", ("VersionGroup", "rb"), ("Version", "red"))]
    assert found(spark, nodes, edges, {"C4", "E1", "B1", "G1", "G2", "C2"}) == [("B1", "snow"), ("C2", "l"), ("C4", "x"), ("E1", "strong"), ("G2", "rb")]


def test_scopes_and_empty_batches(spark):
    chosen = {s.rule_id for s in shapes.select_shapes(SHAPES, ["Machine"], ONTOLOGY)}
    assert chosen == {"L2", "I1", "C2", "X3"}
    assert found(spark, [], []) == []


@pytest.mark.parametrize("name, want", [("HAS_TYPE", "hasType"), ("PLACED", "placed"), ("NOT_VERY_EFFECTIVE_AGAINST", "notVeryEffectiveAgainst")])
def test_property_names(spark, name, want):
    assert spark.createDataFrame([(name,)], "x string").select(shapes.property_name(shapes.F.col("x"))).first()[0] == want
