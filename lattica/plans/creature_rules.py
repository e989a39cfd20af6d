"""The shape rules of the creature universe. Names, limits and lists are fixed values of its ontology."""

from __future__ import annotations

from lattica.operators.shapes import ALWAYS, Apart, Atom, Choice, IsA, Needs, Shape, Together

#: Edges whose slot names their path.
SLOTS = {"HAS_TYPE": ("slot", {"1": "primaryType", "2": "secondaryType"})}

# fixed values
GROWTH_RATES = ("erratic", "fast", "medium_fast", "medium_slow", "slow", "fluctuating")
MOVE_TARGETS = (
    "any_adjacent", "self", "all_adjacent_foes", "any", "all_adjacent", "entire_field", "user_side", "user_and_allies", "random_foe",
    "varies", "all", "foe_side", "adjacent_ally", "user_or_adjacent_ally", "adjacent_foe", "all_allies",
)
ASPECTS = ("biology", "effect", "flavor", "trivia", "origin", "profile", "anime", "manga", "side_game", "pokedex")
TRIGGERS = ("switch_in", "switch_out", "on_attack", "on_hit", "on_knock_out", "low_hp", "end_of_turn", "passive")
EFFECT_TARGETS = ("self", "ally", "foe", "field", "move")
FORM_KINDS = ("alternate", "battle", "mega", "primal", "ultra_burst", "gigantamax", "terastal")
ENCOUNTER_KINDS = ("wild", "raid", "static", "gift", "snag", "migration")
METHODS = (
    "surf", "old-rod", "good-rod", "super-rod", "fishing", "rock-smash", "headbutt", "sos", "horde", "hidden-grotto", "poke-radar",
    "mass-outbreak", "wanderer", "dexnav", "roaming", "max-raid", "dynamax-adventure", "tera-raid", "static", "gift", "snag",
)
ROLES = (("Item", ("use", "hold")), ("Move", ("knownMove",)), ("Type", ("knownMoveType", "partyType")), ("Location", ("atLocation",)), ("PokemonSpecies", ("partySpecies", "tradedFor", "fusesWith")))
NODE_ID = "^[a-z0-9]+(-[a-z0-9]+)*(:[a-z0-9]+(-[a-z0-9]+)*)*$"


def _one(path: str, **what: object) -> Atom:
    return Atom(path, 1, 1, **what)  # type: ignore[arg-type]


def _whole(path: str, least: int = 0, **limits: float) -> Atom:
    """A whole number, at most one."""
    return Atom(path, least, 1, "integer", **limits)  # type: ignore[arg-type]


def _flag(path: str, least: int = 0) -> Atom:
    return Atom(path, least, 1, "boolean")


_EFFECTS = ("MoveEffect", "AbilityEffect", "ItemEffect")
_CHANGES = ("Evolution", "FormChange")

SHAPES: list[Shape] = [
    Shape("L2", "exactly one id, a slug", (_one("id", datatype="string", form=NODE_ID),), ("Entity", "Meta"), scope=(ALWAYS,)),
    Shape("S1", "exactly one number of at least 1", (_whole("pokedexNumber", 1, low=1),), ("PokemonSpecies",)),
    Shape("S2", "one primary type, at most one secondary type, and they differ", (_one("primaryType", cls="Type"), Atom("secondaryType", 0, 1, cls="Type"), Apart(("primaryType", "secondaryType"))), ("PokemonSpecies",)),
    Shape(
        "S3",
        "a female rate unless genderless; a growth rate of the list",
        (
            Atom("femaleRate", 0, 1, "decimal", 0, 1),
            Atom("growthRate", 0, 1, among=GROWTH_RATES),
            Choice(((Atom("isGenderless", 1, among=("true",)), Atom("femaleRate", 0, 0)), (Atom("isGenderless", not_among=("true",)), Atom("femaleRate", 1)))),
        ),
        ("PokemonSpecies",),
    ),
    Shape("S4", "one amount from 1 to 3", (_whole("amount", 1, low=1, high=3),), predicate="yieldsEv", scope=("PokemonSpecies",)),
    Shape("N1", "boosts and reduces different stats other than hit points, or neither", (Apart(("boostsStat", "reducesStat"), both=True), Atom("boostsStat", not_among=("hp",)), Atom("reducesStat", not_among=("hp",))), ("Nature",)),
    Shape("N2", "likes and dislikes different flavors, or neither", (Apart(("likesFlavor", "dislikesFlavor"), both=True),), ("Nature",)),
    Shape("M1", "one type and one damage class", (_one("hasType", cls="Type"), _one("hasDamageClass", cls="MoveDamageClass")), ("Move",)),
    Shape(
        "M2",
        "values of a move",
        (
            _whole("pp", 1, low=1),
            _whole("priority", 1, low=-7, high=5),
            _one("target", among=MOVE_TARGETS),
            _one("introducedIn", cls="Generation"),
            _whole("power", low=1),
            _whole("accuracy", low=1, high=100),
            _whole("critStage", low=1, high=3),
            _flag("isProtectable"),
            _flag("isMirrorable"),
            _whole("minTurns", low=1),
            _whole("maxTurns", low=1),
            Together("minHits", "maxHits", 1),
            Needs(("minHits", "maxHits"), "hasFlag", "multihit"),
            Together("minTurns", "maxTurns"),
        ),
        ("Move",),
    ),
    Shape("K1", "at most one effectiveness a pair", (Apart(("superEffectiveAgainst", "notVeryEffectiveAgainst", "noEffectAgainst")),), ("Type",)),
    Shape("B1", "both durations or neither, in order", (_whole("minTurns", low=1), _whole("maxTurns", low=1), Together("minTurns", "maxTurns")), ("BattleCondition",)),
    Shape(
        "I1",
        "values of an item",
        (Atom("category", 0, 1), _whole("buyPrice", low=0), _whole("sellPrice", low=0), _whole("flingPower", above=0), Choice(((IsA("Machine"),), (_one("introducedIn", cls="Generation"),)))),
        ("Item",),
    ),
    Shape("I2", "one potency above 0", (_whole("potency", 1, above=0),), predicate="hasFlavor", scope=("Berry",)),
    Shape("C2", "links of a machine", (_one("inVersionGroup", cls="VersionGroup"), _one("teachesMove", cls="Move"), _one("machineKind", among=("TM", "HM", "TR")), _whole("machineNumber", 1, low=0)), ("Machine",)),
    Shape("G1", "part of one version group", (_one("partOf", cls="VersionGroup"),), ("Version",)),
    Shape("G2", "part of one generation", (_one("partOf", cls="Generation"),), ("VersionGroup",)),
    Shape("X1", "describes one thing, under one aspect, from a page or from works", (_one("describes"), _one("aspect", among=ASPECTS), Choice(((Atom("source", 1),), (Atom("fromWork", 1),)), just_one=True)), ("TextChunk",)),
    Shape(
        "X2",
        "the aspect decides which works a text may come from",
        (
            Choice(
                (
                    (Atom("aspect", 1, among=("pokedex",)), Atom("fromWork", 1, cls="Version"), Atom("describes", cls="PokemonSpecies")),
                    (Atom("aspect", 1, among=("flavor",)), Atom("fromWork", 1, cls="VersionGroup")),
                    (Atom("aspect", not_among=("pokedex", "flavor")), Atom("fromWork", 0, 0)),
                )
            ),
        ),
        ("TextChunk",),
    ),
    Shape("C2", "in one version group", (_one("inVersionGroup", cls="VersionGroup"),), ("LearnsetEntry",)),
    Shape(
        "E1",
        "values of an effect",
        (_whole("probability", low=0, high=100), _whole("statStages", low=-6, high=6), Atom("hpThreshold", 0, 1, "decimal", 0, 1), Atom("trigger", 0, 1, among=TRIGGERS), Atom("target", 0, 1, among=EFFECT_TARGETS), _flag("isOverworld"), _flag("isProtectable")),
        _EFFECTS,
    ),
    Shape("X3", "one effect text, of a move, an ability or an item", (Choice(((IsA("Move"),), (IsA("Ability"),), (IsA("Item"),))), Atom("effectText", 0, 1, "string")), having="effectText", scope=("Move", "Ability", "Item")),
    Shape("V1", "from one species to one species", (_one("fromSpecies", cls="PokemonSpecies"), _one("toSpecies", cls="PokemonSpecies")), _CHANGES),
    Shape(
        "V2",
        "a form kind of the list; all but alternate forms are for battle only",
        (
            _one("formKind", among=FORM_KINDS),
            _flag("isBattleOnly", 1),
            Choice(((Atom("formKind", 1, among=("alternate",)), Atom("isBattleOnly", 1, among=("false",))), (Atom("formKind", not_among=("alternate",)), Atom("isBattleOnly", 1, among=("true",))))),
        ),
        ("FormChange",),
    ),
    Shape("R1", "one role, which fits the class of the end", (_one("role"), Choice(tuple((Atom("role", 1, among=roles), Atom("object", 1, cls=cls)) for cls, roles in ROLES))), predicate="requires", scope=_CHANGES),
    Shape(
        "C1",
        "an encounter's place, version, species, kind, levels and chance",
        (_one("atLocation", cls="Location"), _one("inVersion", cls="Version"), _one("^hasEncounter", cls="PokemonSpecies"), _one("encounterKind", among=ENCOUNTER_KINDS), Together("minLevel", "maxLevel", both=False), _whole("chance", low=1, high=100)),
        ("Encounter",),
    ),
    Shape("C3", "at most one method of the list", (Atom("method", 0, 1, among=METHODS),), ("Encounter",)),
    Shape("C4", "an item find's place and version", (_one("atLocation", cls="Location"), _one("inVersion", cls="Version"), _flag("isHidden")), ("ItemFind",)),
    Shape("C5", "one direction", (_one("direction", among=("north", "south", "east", "west")),), predicate="adjacentTo", scope=("Location",)),
]
