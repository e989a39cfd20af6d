"""Differences between tables and snapshots, and scores of answers against gold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def symmetric_difference(a: DataFrame, b: DataFrame, key: Sequence[str], sides: tuple[str, str] = ("first", "second")) -> DataFrame:
    """Keys that only one side has, with the side; one full join."""
    left, right = a.select(*key).distinct().withColumn("_a", F.lit(True)), b.select(*key).distinct().withColumn("_b", F.lit(True))
    both = left.join(right, list(key), "full").where("_a is null or _b is null")
    return both.select(*key, F.when(F.col("_b").isNull(), sides[0]).otherwise(sides[1]).alias("side"))


def pin_changes(old: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """Keys added, removed or changed in version between two sets of pins."""
    both = old.select(key, F.col(version).alias("old_version")).join(new.select(key, F.col(version).alias("new_version")), key, "full")
    change = F.when(F.col("old_version").isNull(), "added").when(F.col("new_version").isNull(), "removed").when(F.col("old_version") != F.col("new_version"), "changed")
    return both.withColumn("change", change).where("change is not null")


def cross_check(a: DataFrame, b: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, field, first_value, second_value) wherever two tables differ for a key that both have."""
    named = lambda df, side: df.select(key, *[F.col(f).cast("string").alias(f"{side}_{f}") for f in fields])
    both = named(a, "a").join(named(b, "b"), key)
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").alias("first_value"), F.col(f"b_{f}").alias("second_value")) for f in fields])
    return both.select(key, F.explode(F.filter(pairs, lambda p: ~p["first_value"].eqNullSafe(p["second_value"]))).alias("_p")).select(key, "_p.*")


def precision_recall(cited: DataFrame, gold: DataFrame, questions: DataFrame) -> DataFrame:
    """Per question: cited, gold and common nodes, precision and recall.

    Nothing cited: precision 1 if there is no gold either, else 0. No gold:
    recall 1.
    """
    c = cited.select("question", "node").distinct().withColumn("_c", F.lit(1))
    g = gold.select("question", "node").distinct().withColumn("_g", F.lit(1))
    counts = c.join(g, ["question", "node"], "full").groupBy("question").agg(F.count("_c").alias("cited"), F.count("_g").alias("gold"), F.count_if(F.col("_c").isNotNull() & F.col("_g").isNotNull()).alias("common"))
    rows = questions.select("question").join(counts, "question", "left").na.fill(0, ["cited", "gold", "common"])
    precision = F.when(F.col("cited") == 0, F.when(F.col("gold") == 0, 1.0).otherwise(0.0)).otherwise(F.col("common") / F.col("cited"))
    recall = F.when(F.col("gold") == 0, 1.0).otherwise(F.col("common") / F.col("gold"))
    return rows.select("question", "cited", "gold", "common", precision.alias("precision"), recall.alias("recall"))


def totals(scores: DataFrame, by: str | None = None) -> DataFrame:
    """Numbers of questions and answers, and means over the answered ones, 0 if there are none."""
    grouped = scores.groupBy(by) if by else scores.groupBy()
    mean = lambda c: F.coalesce(F.avg(F.when(F.col("answered"), F.col(c))), F.lit(0.0))
    return grouped.agg(F.count("*").alias("questions"), F.count_if(F.col("answered")).alias("answers"), mean("precision").alias("precision"), mean("recall").alias("recall"))


def first_seen_merge(rows: DataFrame, key: Sequence[str], order: str, values: str) -> DataFrame:
    """One row per key: the first order, and the distinct values in the order in which they first occur."""
    firsts = rows.groupBy(*key, values).agg(F.min(order).alias("_at"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_at", values))), lambda x: x[values])
    return firsts.groupBy(*key).agg(F.min("_at").alias("first_seen"), listed.alias(values))


def truncated(rows: DataFrame, cap: int) -> tuple[DataFrame, bool]:
    """The first ``cap`` rows, and whether there are more; reads one row beyond."""
    return rows.limit(cap), rows.limit(cap + 1).count() > cap


def count_cases(df: DataFrame, by: list[str], cases: dict[str, Column]) -> DataFrame:
    """Per group ``n`` rows, and how many of them fall under each case; a row may fall under several or none."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), *[F.count_if(case).alias(name) for name, case in cases.items()])
