"""Move pages: values, notes, flags, machines, skipped and failed pages, tables checked against pages, and the batch."""

import pytest

from lattica.operators import move_pages
from lattica.operators.move_pages import MoveTables

TABLES = MoveTables(
    flag_fields={"sound": "sound"}, flag_categories={"Biting moves": "bite"}, flags_added={"cut": ["slicing"]}, flags_removed={"cut": ["sound"]},
    crit_categories={"High crit": 1}, crit_overrides={"tackle": 3}, types={"tackle": "Normal"}, hits={"cut": (2, 5), "gone": (1, 2)},
    machines={"tm1": ("TM", ["Red and Blue", "Yellow"]), "hm1": ("HM", ["Gold"])},
)


def page(title, *params, after=""):
    base = {"name": title, "type": "Grass", "damagecategory": "Physical", "basepp": "35", "power": "40", "accuracy": "100", "gen": "I", "target": "anyadjacent", "protect": "yes", "mirrormove": "no"}
    base |= dict(params)
    return (title, "Intro <!-- {{MoveInfobox|name=no}} --> {{MoveInfobox\n" + "".join(f"|{k}={v}\n" for k, v in base.items()) + "}} text\n== A ==\n{{MoveInfobox|name=late}}\n" + after)


@pytest.fixture(scope="module")
def moves(spark):
    pages = [
        page("Cut", ("power", "{{tt|50|30 prior to Champions}}"), ("accuracy", "95{{tt|*|a note}}"), ("priority", "−3"), ("sound", "yes"), ("tm1", "yes"), ("tm#1", "07"), ("hm#1", "3"), ("tm9x", "yes"), after="[[Category:Biting moves]] [[Category:High crit|x]]"),
        page("Tackle", ("power", "—"), ("protect", "maybe"), ("hm1", "yes"), ("type", "'''[[Fire]]'''")),
        page("Broken", ("basepp", "many"), ("target", "nowhere")),
        page("Big", after="[[Category:Max Moves]] [[Category:Multistrike moves]]"),
        page("Many", after="[[Category:Multistrike moves]]"),
        ("Plain", "no box"),
        ("Empty", None),
    ]
    return move_pages.parse_moves(spark.createDataFrame(pages, "title string, wikitext string"), TABLES).cache()


def test_values(moves):
    got = {r.title: r for r in moves.collect()}
    cut, tackle = got["Cut"], got["Tackle"]
    assert (cut.status, cut.move, cut.pp, cut.power, cut.accuracy, cut.priority, cut.target) == ("parsed", "cut", 35, 30, 95, -3, "any_adjacent")
    assert (cut.flags, cut.crit_stage, cut.min_hits, cut.max_hits, cut.is_protectable, cut.is_mirrorable) == (["bite", "slicing"], 1, 2, 5, True, False)
    assert {n.kind for n in cut.notes} == {"champions_value", "override_applied"}
    assert (tackle.power, tackle.priority, tackle.type, tackle.crit_stage, tackle.is_protectable) == (None, 0, "Normal", 3, None)
    assert {(n.kind, n.detail) for n in tackle.notes} == {("missing_boolean", "protect is maybe"), ("table_row_applied", "Fire to Normal")}
    assert {t: (r.status, r.reasons) for t, r in got.items() if r.status != "parsed"} == {"Broken": ("failed", ["basepp", "target"]), "Big": ("skipped", ["max_move"]), "Plain": ("skipped", ["no_infobox"]), "Empty": ("skipped", ["no_infobox"])}


def test_machines_and_tables(moves):
    got = sorted((tuple(r) for r in move_pages.machines(moves, TABLES).collect()), key=str)
    assert got == sorted(
        [("cut", "TM", "07", "Red and Blue", "tm1", None), ("cut", "TM", "07", "Yellow", "tm1", None), ("cut", "HM", "3", None, "hm1", "number without a flag"), ("tackle", "HM", "", None, "hm1", "no number"), ("cut", None, "yes", None, "tm9x", "unknown field")], key=str
    )
    assert sorted(map(tuple, move_pages.table_problems(moves, TABLES).collect())) == [("hits", "cut", "not of the category"), ("hits", "gone", "no such move"), ("hits", "many", "lacking")]


def test_batch(spark, moves):
    texts = spark.createDataFrame([("cut", "Cuts.")], "move string, effect_text string")
    nodes, edges = move_pages.move_batch(moves, move_pages.machines(moves, TABLES), "u", texts)
    found = {(r.key_label, r.id): r.props for r in nodes.collect()}
    assert set(found) == {("Move", "cut"), ("Move", "tackle"), ("Move", "many"), ("Machine", "tm7:red-and-blue"), ("Machine", "tm7:yellow")}
    assert (found["Move", "cut"].effect_text, found["Move", "cut"].power, found["Machine", "tm7:yellow"].machine_number) == ("Cuts.", 30, 7)
    ends = {(r.type, r.src_id, r.dst_id) for r in edges.collect()}
    assert {("HAS_TYPE", "tackle", "normal"), ("HAS_DAMAGE_CLASS", "cut", "physical"), ("INTRODUCED_IN", "cut", "generation-i"), ("HAS_FLAG", "cut", "bite"), ("TEACHES_MOVE", "tm7:yellow", "cut"), ("IN_VERSION_GROUP", "tm7:yellow", "yellow")} <= ends
