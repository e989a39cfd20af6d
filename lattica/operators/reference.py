"""Joins against reference data: dimension tables, names, places, and what is referred to but owned by nobody.

Reference tables are read as texts. Joins are plain equi-joins; Catalyst
broadcasts the small side where its size allows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.functions import naming
from lattica.functions.wikitext import templates

ENGLISH = "9"


def _number(text: Column) -> Column:
    """A whole number, null for an empty text."""
    return F.when(F.length(text) > 0, text).cast("int")


def _lookup(values: Mapping[str, object], key: Column) -> Column:
    """The value of ``key`` in a small table; null if it has none."""
    if not values:
        return F.lit(None).cast("string")
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def _identifiers(df: DataFrame, id_name: str, name: str) -> DataFrame:
    return df.select(F.col("id").alias(id_name), F.col("identifier").alias(name))


def english_texts(prose: DataFrame, key: str) -> DataFrame:
    """(key, effect_text) of the English short effects that aren't empty."""
    return prose.where((F.col("local_language_id") == ENGLISH) & (F.length("short_effect") > 0)).select(key, F.col("short_effect").alias("effect_text"))


def machine_keys(machines: DataFrame, items: DataFrame, version_groups: DataFrame, *, skipped: Sequence[str] = (), folded: Mapping[str, str] = {}, form: str = r"(?i)^(tm|hm|tr)(\d+)$") -> DataFrame:
    """(move_id, kind, number, version_group) of machines, numbered by their item's identifier.

    Machines of ``skipped`` groups and items of another form are left out;
    ``folded`` groups count as the group they belong to.
    """
    rows = machines.join(_identifiers(items, "item_id", "_item"), "item_id").join(_identifiers(version_groups, "version_group_id", "_group"), "version_group_id")
    rows = rows.where(~F.col("_group").isin(list(skipped)) & F.col("_item").rlike(form))
    group = F.coalesce(_lookup(folded, F.col("_group")), F.col("_group"))
    return rows.select("move_id", F.upper(F.regexp_extract("_item", form, 1)).alias("kind"), F.regexp_extract("_item", form, 2).cast("int").alias("number"), group.alias("version_group")).distinct()


def move_index(moves: DataFrame, types: DataFrame, classes: DataFrame, meta: DataFrame, prose: DataFrame, *, below: int, renamed: Mapping[str, str] = {}, crit_stages: Mapping[str, int] = {}) -> DataFrame:
    """One row per regular move (ids under ``below``): its values, type, class, hits and English text; ``move`` is its id elsewhere."""
    rows = moves.where(F.col("id").cast("int") < below)
    rows = rows.join(_identifiers(types, "type_id", "type"), "type_id").join(_identifiers(classes, "damage_class_id", "damage_class"), "damage_class_id")
    own = meta.select(F.col("move_id").alias("id"), F.lit(True).alias("_meta"), "crit_rate", "min_hits", "max_hits")
    rows = rows.join(own, "id", "left").join(english_texts(prose, "move_effect_id").withColumnRenamed("move_effect_id", "effect_id"), "effect_id", "left")
    return rows.select(
        F.col("id").alias("move_id"),
        F.coalesce(_lookup(renamed, F.col("identifier")), F.col("identifier")).alias("move"),
        "identifier",
        *[_number(F.col(c)).alias(c) for c in ("power", "accuracy", "pp", "priority")],
        "type",
        "damage_class",
        F.coalesce("_meta", F.lit(False)).alias("has_meta"),
        _lookup(crit_stages, F.col("crit_rate")).cast("int").alias("crit_stage"),
        *[_number(F.col(c)).alias(c) for c in ("min_hits", "max_hits")],
        "effect_text",
    )


def ability_index(abilities: DataFrame, prose: DataFrame) -> DataFrame:
    """(ability, effect_text) of all abilities; null without an English text."""
    return _identifiers(abilities, "ability_id", "ability").join(english_texts(prose, "ability_id"), "ability_id", "left").select("ability", "effect_text")


def machine_differences(pages: DataFrame, tables: DataFrame) -> DataFrame:
    """(move, machine, side) of machines (move, kind, number, version_group) that only the pages or only the tables have, among moves that both know."""
    shown = F.concat("kind", F.col("number").cast("string"), F.lit(" "), "version_group")
    a, b = (x.select("move", shown.alias("machine")).distinct() for x in (pages, tables))
    both = pages.select("move").distinct().join(tables.select("move").distinct(), "move", "left_semi")
    only = a.join(b, ["move", "machine"], "left_anti").withColumn("side", F.lit("page")).unionByName(b.join(a, ["move", "machine"], "left_anti").withColumn("side", F.lit("table")))
    return only.join(both, "move", "left_semi")


def resolve_forms(refs: DataFrame, names: DataFrame, forms: DataFrame) -> DataFrame:
    """References (name, code) with ``id`` and ``fallback``.

    names: name, base. forms: id. The name gives a base id; with a code,
    the id of base and code if there is one, else the base as a fallback. An
    unknown name gives null.
    """
    based = refs.join(names.select("name", F.col("base").alias("_base")), "name", "left")
    wanted = F.when(F.length("code") > 0, F.concat_ws("-", "_base", "code"))
    rows = based.withColumn("_form", F.when(F.col("_base").isNotNull(), wanted)).join(forms.select(F.col("id").alias("_form"), F.lit(True).alias("_known")).distinct(), "_form", "left")
    id_ = F.when(F.col("_known"), F.col("_form")).otherwise(F.col("_base"))
    return rows.select(*refs.columns, id_.alias("id"), (F.col("_form").isNotNull() & F.col("_known").isNull()).alias("fallback"))


def resolve_labels(rows: DataFrame, individuals: DataFrame) -> DataFrame:
    """``rows`` (class, label) with the id of the individual (class, label, id) they name; null if there is none."""
    return rows.join(individuals.select("class", "label", "id").dropDuplicates(["class", "label"]), ["class", "label"], "left")


def resolve_mentions(mentions: DataFrame, species: DataFrame, individuals: DataFrame, trusted: Sequence[str]) -> DataFrame:
    """Mentions (subject, class, target) with ``id`` and ``how``: species, individual, stub, self or unresolved.

    species: name, id. individuals: class, label, id. A class in ``trusted``
    may be a stub, whose id is the slug of its target. A mention of its own
    subject is no link.
    """
    s = species.select(F.col("name").alias("target"), F.col("id").alias("_s")).dropDuplicates(["target"])
    i = individuals.select("class", F.col("label").alias("target"), F.col("id").alias("_i")).dropDuplicates(["class", "target"])
    rows = mentions.join(s, "target", "left").join(i, ["class", "target"], "left")
    stub = F.when(F.col("class").isin(list(trusted)), naming.node_id(F.col("target")))
    id_ = F.when(F.col("class") == "PokemonSpecies", F.col("_s")).otherwise(F.coalesce("_i", stub))
    how = F.when(id_.isNull(), "unresolved").when(id_ == F.col("subject"), "self").when(F.col("class") == "PokemonSpecies", "species").when(F.col("_i").isNotNull(), "individual").otherwise("stub")
    return rows.select(*mentions.columns, id_.alias("id"), how.alias("how"))


def title_index(pins: DataFrame, suffix: str) -> DataFrame:
    """(name, base) of pinned titles: the title without ``suffix``, and its slug."""
    name = F.when(F.col("title").endswith(suffix), F.substring(F.col("title"), F.lit(1), F.length("title") - len(suffix))).otherwise(F.col("title"))
    return pins.select(name.alias("name")).distinct().select("name", naming.species_id(F.col("name")).alias("base"))


def unowned(referred: DataFrame, owners: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that are referred to and that no owner has, with how often."""
    return referred.groupBy(*key).agg(F.count("*").alias("n")).join(owners.select(*key), list(key), "left_anti")


def miss_counts(stubs: DataFrame, seeded: DataFrame, owned: DataFrame, owned_classes: Sequence[str]) -> DataFrame:
    """One row: distinct stubs (class, id) that neither seeds nor owners have: owner_misses among ``owned_classes``, seed_misses among the others."""
    keys = ["class", "id"]
    lost = stubs.select(*keys).distinct().join(seeded.select(*keys), keys, "left_anti").join(owned.select(*keys), keys, "left_anti")
    ours = F.col("class").isin(list(owned_classes))
    return lost.agg(F.count_if(~ours).alias("seed_misses"), F.count_if(ours).alias("owner_misses"))


def location_index(pages: DataFrame, foreign: DataFrame, infoboxes: Sequence[str]) -> DataFrame:
    """(title, kind, target): pages (title, wikitext) as location, other or redirect with its target, and ``foreign`` titles, which win."""
    target = naming.redirect_target(F.col("wikitext"))
    lead = F.element_at(F.split("wikitext", r"(?m)^=="), 1)
    boxed = F.exists(templates(lead), lambda t: t["name"].isin(list(infoboxes)))
    own = pages.select(naming.normalize_title(F.col("title")).alias("title"), F.when(target.isNotNull(), "redirect").when(boxed, "location").otherwise("other").alias("kind"), target.alias("target"))
    others = foreign.select(naming.normalize_title(F.col("title")).alias("title"), F.lit("foreign").alias("kind"), F.lit(None).cast("string").alias("target"))
    return own.unionByName(others.distinct())


def classify_locations(candidates: DataFrame, index: DataFrame) -> DataFrame:
    """Candidates (title) with ``verdict`` and ``page``, the title that it is about.

    A redirect is followed one step. A title that is foreign, or leads to one,
    is no location; what leads to a location is that; what leads to any other
    known page, a further redirect too, is none; the rest is unknown.
    """
    foreign = index.where("kind = 'foreign'").select(F.col("title").alias("_f")).distinct()
    known = index.where("kind <> 'foreign'").dropDuplicates(["title"])
    rows = candidates.withColumn("_t", naming.normalize_title(F.col("title")))
    rows = rows.join(known.where("kind = 'redirect'").select(F.col("title").alias("_t"), F.col("target").alias("_to")), "_t", "left").withColumn("_to", F.coalesce("_to", "_t"))
    rows = rows.join(foreign.withColumnRenamed("_f", "_t").withColumn("_tf", F.lit(True)), "_t", "left").join(foreign.withColumnRenamed("_f", "_to").withColumn("_of", F.lit(True)), "_to", "left")
    rows = rows.join(known.select(F.col("title").alias("_to"), F.col("kind").alias("_kind")), "_to", "left")
    verdict = F.when(F.col("_tf") | F.col("_of"), "not_a_location").when(F.col("_kind") == "location", "location").when(F.col("_kind").isNotNull(), "not_a_location").otherwise("unknown_location")
    rows = rows.withColumn("verdict", verdict)
    return rows.select(*candidates.columns, "verdict", F.when(F.col("verdict") == "not_a_location", F.col("_t")).otherwise(F.col("_to")).alias("page"))


def candidate_titles(index: DataFrame, unknown: DataFrame) -> DataFrame:
    """Known and unknown titles without the foreign ones, each once."""
    titles = index.where("kind <> 'foreign'").select("title").union(unknown.select(naming.normalize_title(F.col("title")))).distinct()
    return titles.join(index.where("kind = 'foreign'").select("title"), "title", "left_anti")


def ranked_counts(rows: DataFrame, key: str) -> DataFrame:
    """(key, n, rank): most frequent first, then by key. Only the counts, one row a key, are ranked."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), key).select(key, "n")


def case_counts(rows: DataFrame, dimensions: Sequence[str], none: str = "none") -> DataFrame:
    """(dimension, value, n) of several columns in one pass; nulls count under ``none``."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit(none)).alias("value")) for d in dimensions])
    return rows.select(F.explode(pairs).alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("n"))


def final_flags(fields: Column, categories: Column, added: Column, removed: Column) -> Column:
    """Flags from fields and categories and those added by hand, without those removed by hand."""
    return F.array_sort(F.array_except(F.array_union(F.array_union(fields, categories), added), removed))
