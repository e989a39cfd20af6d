"""Facts of move pages: infobox values, flags, machines and notes, as columns.

Only the reading of templates and plain text runs in Python, in Arrow batches;
what the values mean is decided by expressions over the infobox, a map. A page
whose value no rule can read fails by itself, with all its reasons.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.functions import naming
from lattica.functions.wikitext import page_categories, plain, templates

# fixed values
NO_VALUE = ("", "—", "N/A", "Varies")
SKIPPED = {"Z-Moves": "z_move", "Max Moves": "max_move", "G-Max Moves": "g_max_move"}
TARGETS = {
    "anyadjacent": "any_adjacent", "self": "self", "adjacentfoes": "all_adjacent_foes", "any": "any", "alladjacent": "all_adjacent",
    "allfield": "entire_field", "allyfield": "user_side", "team": "user_and_allies", "random": "random_foe", "varies": "varies", "all": "all",
    "foes": "foe_side", "adjacentally": "adjacent_ally", "selfadjacentally": "user_or_adjacent_ally", "adjacentfoe": "adjacent_foe", "allies": "all_allies",
}
_OLDER = r"(\d+) prior to (?:Pokémon )?Champions"
_FOOTNOTE = r"\{\{\s*[Tt]t\s*\|\s*\*\s*\|[^{}]*\}\}"
_ANNOTATED = r"^\s*\{\{\s*[Tt]t\s*\|([^|{}]*)\|?([^{}]*)\}\}\s*$"
_MACHINE_FIELD = r"^(?:tm|hm|tr)[a-z0-9]+$"


@dataclass(frozen=True)
class MoveTables:
    """What pages alone don't tell: which fields and categories are flags, corrections by move id, and the version groups of machine fields."""

    flag_fields: Mapping[str, str] = field(default_factory=dict)
    flag_categories: Mapping[str, str] = field(default_factory=dict)
    flags_added: Mapping[str, Sequence[str]] = field(default_factory=dict)
    flags_removed: Mapping[str, Sequence[str]] = field(default_factory=dict)
    crit_categories: Mapping[str, int] = field(default_factory=dict)
    crit_overrides: Mapping[str, int] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    hits: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    turns: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    #: field -> (kind, labels of version groups)
    machines: Mapping[str, tuple[str, Sequence[str]]] = field(default_factory=dict)
    multistrike: str = "Multistrike moves"

    def by_id(self) -> dict[str, Mapping[str, object]]:
        return {"flags_added": self.flags_added, "flags_removed": self.flags_removed, "crit_overrides": self.crit_overrides, "types": self.types, "hits": self.hits, "turns": self.turns}


def _map(values: Mapping[str, object], kind: str) -> Column:
    if not values:
        return F.create_map().cast(f"map<string,{kind}>")
    lit = lambda v: F.array(*map(F.lit, v)) if isinstance(v, tuple | list) else F.lit(v)
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), lit(v))]).cast(f"map<string,{kind}>")


def infoboxes(pages: DataFrame, name: str) -> DataFrame:
    """``pages`` (title, wikitext) with ``box``, the parameters of the lead's first template of that name, null without one, and ``categories``."""
    lead = F.element_at(F.split("wikitext", r"(?m)^=="), 1)
    box = F.filter(templates(lead), lambda t: t["name"] == name)
    return pages.withColumn("box", F.when(F.size(box) > 0, F.element_at(box, 1)["params"])).withColumn("categories", page_categories(F.col("wikitext")))


def _text(key: str) -> Column:
    return F.trim(F.coalesce(F.col("box")[key], F.lit("")))


def _yes(key: str) -> Column:
    return F.lower(_text(key)).isin("yes", "true")


def _number(key: str) -> tuple[Column, Column, Column]:
    """(value, whether unreadable, note) of a number: an older value named in a note wins; marks for no value give null."""
    raw = F.regexp_replace(_text(key), _FOOTNOTE, "")
    noted = raw.rlike(_ANNOTATED)
    value, note = F.when(noted, F.regexp_extract(raw, _ANNOTATED, 1)).otherwise(raw), F.when(noted, F.regexp_extract(raw, _ANNOTATED, 2)).otherwise(F.lit(""))
    older = F.regexp_extract(note, _OLDER, 1)
    shown = F.trim(F.replace(plain(F.when(F.length(older) > 0, older).otherwise(value)), F.lit("−"), F.lit("-")))
    empty = shown.isin(*NO_VALUE)
    whole = shown.rlike(r"^[+-]?\d+$")
    return F.when(whole, F.regexp_replace(shown, r"^\+", "").cast("int")), ~empty & ~whole, F.when(F.length(older) > 0, F.struct(F.lit("champions_value").alias("kind"), F.lit(key).alias("field"), F.trim(note).alias("detail")))


def _boolean(key: str) -> tuple[Column, Column]:
    value = F.lower(_text(key))
    known = F.when(value.isin("yes", "true"), F.lit(True)).when(value.isin("no", "false"), F.lit(False))
    detail = F.when(F.length(value) > 0, F.concat(F.lit(f"{key} is "), value)).otherwise(F.lit(f"no {key} field"))
    return known, F.when(known.isNull(), F.struct(F.lit("missing_boolean").alias("kind"), F.lit(key).alias("field"), detail.alias("detail")))


_NUMBERS = {"pp": "basepp", "power": "power", "accuracy": "accuracy", "priority": "priority"}


def parse_moves(pages: DataFrame, tables: MoveTables = MoveTables()) -> DataFrame:
    """One row per page: title, status (parsed, skipped or failed), reasons, and a move's facts.

    Columns: move, name, type, damage_class, pp, power, accuracy, priority,
    target, generation, is_protectable, is_mirrorable, flags, crit_stage,
    min_hits, max_hits, min_turns, max_turns, box, categories, notes. Null and
    empty pages are skipped for want of an infobox.
    """
    rows = infoboxes(pages, "moveinfobox")
    name = F.trim(plain(_text("name")))
    rows = rows.withColumn("name", name).withColumn("move", naming.node_id(F.col("name")))
    number = {c: _number(key) for c, key in _NUMBERS.items()}
    protect, mirror = _boolean("protect"), _boolean("mirrormove")
    given = F.trim(plain(_text("type")))
    override = _map(tables.types, "string")[F.col("move")]
    target = _map(TARGETS, "string")[F.trim(plain(_text("target")))]
    category = lambda values, kind: [F.when(F.array_contains("categories", c), F.lit(v).cast(kind)) for c, v in values.items()]
    none = F.array().cast("array<string>")
    own = F.array(*[F.when(_yes(k), F.lit(v)) for k, v in tables.flag_fields.items()], *category(tables.flag_categories, "string")) if tables.flag_fields or tables.flag_categories else none
    by_move = lambda values: F.coalesce(_map({k: list(v) for k, v in values.items()}, "array<string>")[F.col("move")], none)
    flags = F.array_sort(F.array_except(F.array_union(F.filter(own, lambda f: f.isNotNull()), by_move(tables.flags_added)), by_move(tables.flags_removed)))
    stage = F.array_max(F.array(*category(tables.crit_categories, "int"))) if tables.crit_categories else F.lit(None).cast("int")
    span = lambda values: _map(values, "array<int>")[F.col("move")]
    note = lambda when, kind, of, detail: F.when(when, F.struct(F.lit(kind).alias("kind"), F.lit(of).alias("field"), detail.alias("detail")))
    corrected = F.size(by_move(tables.flags_added)) + F.size(by_move(tables.flags_removed)) > 0
    notes = [n for _, _, n in number.values()] + [protect[1], mirror[1], note(override.isNotNull(), "table_row_applied", "types", F.concat(given, F.lit(" to "), override)), note(corrected, "override_applied", "flags", F.array_join(flags, ","))]
    needed = {"name": name, "type": given, "damagecategory": F.trim(plain(_text("damagecategory"))), "gen": F.trim(plain(_text("gen"))), "target": target}
    faults = [F.when(bad, F.lit(_NUMBERS[c])) for c, (_, bad, _) in number.items()] + [F.when(F.coalesce(F.length(v), F.lit(0)) == 0, F.lit(k)) for k, v in needed.items()]
    outside = reduce(lambda rest, x: F.when(F.array_contains("categories", x[0]), x[1]).otherwise(rest), reversed(SKIPPED.items()), F.when(_text("type") == "Shadow", "shadow"))
    skipped = F.when(F.col("box").isNull(), "no_infobox").otherwise(outside)
    failed = F.filter(F.array(*faults), lambda x: x.isNotNull())
    return rows.select(
        "title",
        F.when(skipped.isNotNull(), "skipped").when(F.size(failed) > 0, "failed").otherwise("parsed").alias("status"),
        F.when(skipped.isNotNull(), F.array(skipped)).otherwise(failed).alias("reasons"),
        "move",
        "name",
        F.coalesce(override, given).alias("type"),
        needed["damagecategory"].alias("damage_class"),
        *[F.coalesce(v, F.lit(0)).alias(c) if c == "priority" else v.alias(c) for c, (v, _, _) in number.items()],
        target.alias("target"),
        needed["gen"].alias("generation"),
        protect[0].alias("is_protectable"),
        mirror[0].alias("is_mirrorable"),
        flags.alias("flags"),
        F.coalesce(_map(tables.crit_overrides, "int")[F.col("move")], stage).alias("crit_stage"),
        span(tables.hits)[0].alias("min_hits"),
        span(tables.hits)[1].alias("max_hits"),
        span(tables.turns)[0].alias("min_turns"),
        span(tables.turns)[1].alias("max_turns"),
        "box",
        "categories",
        F.filter(F.array(*notes), lambda n: n.isNotNull()).alias("notes"),
    )


def machines(moves: DataFrame, tables: MoveTables) -> DataFrame:
    """(move, kind, number_text, version_group, field, problem) of parsed moves' machine fields.

    A field set to yes with a number gives a row for each version group. The
    rest are rows with a problem: a number without a yes, a yes without a
    number, and fields that no table knows.
    """
    rows = moves.where("status = 'parsed'")
    known = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(kind).alias("kind"), F.array(*map(F.lit, labels)).alias("labels")) for f, (kind, labels) in tables.machines.items()]) if tables.machines else F.expr("cast(array() as array<struct<field:string,kind:string,labels:array<string>>>)")
    numbered = rows.select("move", "box", F.explode(known).alias("m"))
    text = F.trim(F.coalesce(F.col("box")[F.concat(F.substring("m.field", 1, 2), F.lit("#"), F.expr("substring(m.field, 3)"))], F.lit("")))
    on = F.lower(F.trim(F.coalesce(F.col("box")[F.col("m.field")], F.lit("")))).isin("yes", "true")
    numbered = numbered.select("move", "m.kind", text.alias("number_text"), "m.labels", "m.field", on.alias("on"))
    digits = F.col("number_text").rlike(r"^\d+$")
    none = F.lit(None).cast("string")
    sound = numbered.where(F.col("on") & digits).select("move", "kind", "number_text", F.explode("labels").alias("version_group"), "field", none.alias("problem"))
    problem = F.when(F.col("on"), "no number").otherwise("number without a flag")
    odd = numbered.where((F.col("on") & ~digits) | (~F.col("on") & (F.length("number_text") > 0))).select("move", "kind", "number_text", none, "field", problem)
    fields = F.filter(F.map_keys("box"), lambda k: k.rlike(_MACHINE_FIELD) & ~k.isin(list(tables.machines)))
    unknown = rows.select("move", F.explode(fields).alias("field"), "box").select("move", none, F.trim(F.col("box")[F.col("field")]), none, "field", F.lit("unknown field"))
    return sound.union(odd).union(unknown)


def table_problems(moves: DataFrame, tables: MoveTables) -> DataFrame:
    """(table, move, problem): table rows that name no parsed move, and moves of the multistrike category and of the hits table that don't agree."""
    spark = moves.sparkSession
    parsed = moves.where("status = 'parsed'")
    named = spark.createDataFrame([(t, m) for t, values in tables.by_id().items() for m in values], "table string, move string")
    lost = named.join(parsed.select("move"), "move", "left_anti").select("table", "move", F.lit("no such move").alias("problem"))
    several = parsed.where(F.array_contains("categories", tables.multistrike)).select("move")
    hits = named.where("table = 'hits'").join(parsed.select("move"), "move", "left_semi").select("move")
    lacking = several.join(hits, "move", "left_anti").select(F.lit("hits"), "move", F.lit("lacking"))
    extra = hits.join(several, "move", "left_anti").select(F.lit("hits"), "move", F.lit("not of the category"))
    return lost.union(lacking).union(extra)


def move_batch(moves: DataFrame, facts: DataFrame, universe: str, effect_texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of parsed moves: nodes with their values in ``props``; edges to type, class, generation and flags, and from machines to move and version group.

    facts: what :func:`machines` gives. effect_texts: move, effect_text.
    """
    rows = moves.where("status = 'parsed'").join(effect_texts.select("move", "effect_text"), "move", "left")
    values = ["pp", "power", "accuracy", "priority", "target", "is_protectable", "is_mirrorable", "crit_stage", "min_hits", "max_hits", "min_turns", "max_turns", "effect_text"]
    kinds = dict(rows.dtypes)
    props = lambda **own: F.struct(*[own.get(v, F.lit(None)).cast(kinds[v]).alias(v) for v in values], own.get("machine_kind", F.lit(None)).cast("string").alias("machine_kind"), own.get("machine_number", F.lit(None)).cast("int").alias("machine_number"))
    node = lambda df, label, id_, name, **own: df.select(F.lit(universe).alias("universe"), F.lit(label).alias("key_label"), id_.alias("id"), name.alias("name"), props(**own).alias("props"))
    edge = lambda df, type_, src, dst: df.select(F.lit(universe).alias("universe"), F.lit(type_).alias("type"), F.lit(src[0]).alias("src_label"), src[1].alias("src_id"), F.lit(dst[0]).alias("dst_label"), dst[1].alias("dst_id"))
    sound = facts.where("problem is null")
    number = F.col("number_text").cast("int")
    machine = F.concat_ws(":", naming.node_id(F.concat("kind", number.cast("string"))), naming.node_id(F.col("version_group")))
    nodes = node(rows, "Move", F.col("move"), F.col("name"), **{v: F.col(v) for v in values}).unionByName(node(sound, "Machine", machine, F.concat("kind", number.cast("string")), machine_kind=F.col("kind"), machine_number=number))
    move = ("Move", F.col("move"))
    edges = [
        edge(rows, "HAS_TYPE", move, ("Type", naming.node_id(F.col("type")))),
        edge(rows, "HAS_DAMAGE_CLASS", move, ("MoveDamageClass", naming.node_id(F.col("damage_class")))),
        edge(rows, "INTRODUCED_IN", move, ("Generation", naming.node_id(F.concat(F.lit("Generation "), F.col("generation"))))),
        edge(rows.select("move", F.explode("flags").alias("flag")), "HAS_FLAG", move, ("MoveFlag", F.col("flag"))),
        edge(sound, "TEACHES_MOVE", ("Machine", machine), move),
        edge(sound, "IN_VERSION_GROUP", ("Machine", machine), ("VersionGroup", naming.node_id(F.col("version_group")))),
    ]
    return nodes, reduce(DataFrame.unionByName, edges)
