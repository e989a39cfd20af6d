"""Order within groups: numbers, running values, spans. Windows are partitioned, so that no order spans the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.functions.naming import text_key


def number_within(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """``df`` with each row's number in its group, from ``start``."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(name, (nth + F.lit(start - 1)).cast("long"))


def number_chunks(chunks: DataFrame, by_text: Sequence[str]) -> DataFrame:
    """Chunks (subject, aspect, seq, text) with a key within subject and aspect.

    Aspects of ``by_text`` take a hash of the text, so that keys outlive
    changes of order; others their number, from 1.
    """
    numbered = number_within(chunks, ["subject", "aspect"], ["seq"], "_nth")
    key = F.when(F.col("aspect").isin(list(by_text)), text_key(F.col("text"))).otherwise(F.col("_nth").cast("string"))
    return numbered.withColumn("key", key).drop("_nth")


def key_collisions(chunks: DataFrame) -> DataFrame:
    """(subject, aspect, key, texts) of numbered chunks whose key stands for several texts."""
    return chunks.groupBy("subject", "aspect", "key").agg(F.count_distinct("text").alias("texts")).where("texts > 1")


def residue_ids(items: DataFrame) -> DataFrame:
    """Items (page, kind, seq) with ``residue``: page, kind and number, joined by colons."""
    numbered = number_within(items, ["page", "kind"], ["seq"], "_nth")
    return numbered.withColumn("residue", F.concat_ws(":", "page", "kind", "_nth")).drop("_nth")


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, reset: Column, name: str) -> DataFrame:
    """``df`` with the latest ``value`` up to each row, null again from a row on for which ``reset`` holds until the next value."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(value.isNotNull(), F.struct(value.alias("v"))).when(reset, F.struct(F.lit(None).cast("bigint").alias("v")))
    return df.withColumn(name, F.last(mark, ignorenulls=True).over(w)["v"])


def pick_span(df: DataFrame, by: Sequence[str], tie: str, current: int) -> DataFrame:
    """One row a group, by its span (first, last; an open end is null): one that holds ``current`` and ends last, else one without a span, else the one that ends last; ties go to the least ``tie``."""
    until = F.coalesce("last", F.lit(99))
    rank = F.when(F.col("first").isNull(), 1).when((F.col("first") <= current) & (until >= current), 2).otherwise(0)
    order = F.struct(rank, F.when(F.col("first").isNull(), 0).otherwise(until), -F.col(tie))
    best = df.groupBy(*by).agg(F.max_by(F.struct(*[c for c in df.columns if c not in by]), order).alias("_best"))
    return best.select(*by, "_best.*")
