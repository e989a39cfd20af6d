"""Fuzzy name lookup: an index of tokens, joins on tokens and deletions, a score, a ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FETCHED, KEPT = 50, 15
#: Words of at least so many letters and digits may differ by one edit.
FUZZY_FROM = 4
NAME_BOOST = 2.0


def tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: F.length(t) > 0))


def _variants(token: Column) -> Column:
    """The token, and for longer ones what is left after deleting any one character: two words within one edit share a variant."""
    cut = F.transform(F.sequence(F.lit(1), F.length(token)), lambda k: F.concat(F.left(token, k - 1), F.right(token, F.length(token) - k)))
    return F.when(F.length(token) >= FUZZY_FROM, F.array_distinct(F.concat(F.array(token), cut))).otherwise(F.array(token))


#: A name counts so much more than an alias; candidates below the floor are dropped.
ALIAS_BOOST, SCORE_FLOOR = 1.0, 3.7


def name_index(nodes: DataFrame) -> DataFrame:
    """(variant, token, boost, key_label, id, name): one row per variant of a token of a name or, where the properties have ``aliases``, of an alias."""
    fields = [f.name for f in nodes.schema["props"].dataType.fields] if "props" in nodes.columns else []
    aliases = F.coalesce(F.col("props.aliases"), F.array().cast("array<string>")) if "aliases" in fields else F.array().cast("array<string>")
    named = F.concat(F.array(F.struct(F.col("name").alias("text"), F.lit(NAME_BOOST).alias("boost"))), F.transform(aliases, lambda a: F.struct(a.alias("text"), F.lit(ALIAS_BOOST).alias("boost"))))
    rows = nodes.select("key_label", "id", "name", F.explode(named).alias("_n")).select("key_label", "id", "name", "_n.boost", F.explode(tokens(F.col("_n.text"))).alias("token"))
    rows = rows.groupBy("key_label", "id", "name", "token").agg(F.max("boost").alias("boost"))
    return rows.withColumn("variant", F.explode(_variants(F.col("token"))))


def look_up(mentions: DataFrame, nodes: DataFrame, least: float = 0.0) -> DataFrame:
    """Candidates for mentions (position, mention, label): position, key_label, id, name, score, rank.

    A mention's token scores its inverse frequency among names, halved for an
    inexact match, each token's best match counting once. The best FETCHED by
    score stay, then KEPT by: label as guessed, score, short names, id.
    """
    index = name_index(nodes)
    total = nodes.count()
    rarity = index.select("token", "key_label", "id").distinct().groupBy("token").agg(F.log(F.lit(1.0 + total) / (1.0 + F.count("*"))).alias("idf"))
    asked = mentions.select("position", "label", F.explode(tokens(F.col("mention"))).alias("word")).withColumn("variant", F.explode(_variants(F.col("word"))))
    hits = asked.join(index, "variant").where((F.col("word") == F.col("token")) | (F.levenshtein("word", "token", 1) >= 0))
    hits = hits.join(rarity, "token").withColumn("gain", F.col("boost") * F.col("idf") * F.when(F.col("word") == F.col("token"), 1.0).otherwise(0.5))
    best = hits.groupBy("position", "label", "word", "key_label", "id", "name").agg(F.max("gain").alias("gain"))
    scored = best.groupBy("position", "label", "key_label", "id", "name").agg(F.round(F.sum("gain"), 6).alias("score")).where(F.col("score") >= least)
    by_score = Window.partitionBy("position").orderBy(F.desc("score"), "id", "key_label")
    return rank_candidates(scored.withColumn("_n", F.row_number().over(by_score)).where(F.col("_n") <= FETCHED).drop("_n")).select("position", "key_label", "id", "name", "score", "rank")


def rank_candidates(candidates: DataFrame) -> DataFrame:
    """The best KEPT candidates (position, label, key_label, id, name, score) of each mention, with ``rank``: those of the guessed label first, then by score, short names, id."""
    order = Window.partitionBy("position").orderBy((F.col("key_label") != F.coalesce("label", F.lit(""))).cast("int"), F.desc("score"), F.length("name"), "id", "key_label")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= KEPT)
