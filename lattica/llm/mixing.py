"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Every document of a source has the same expected number of copies, the source's
target divided by its size. Laid end to end, the expected copies of a source
are a line; one random offset places a comb of integers on it, and a document
is emitted once for each integer that its stretch holds. The stretch of a
document starts at the prefix sum of all documents before it.

The prefix sum never brings a source together: documents are cut into cells of
like size and a hash of the id, each cell is numbered for itself, and the
cells' counts, a small table, give where each cell starts. Since the line is
ordered by size classes, a source's taken size stays within about one document
per cell of its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.llm.common import WORD, hash_bucket, hash_unit, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
SALTS = 16


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Grows with the size, by one for about a quarter more: the number of bits, then the first three."""
    bits = F.length(F.bin(size))
    return (bits * 8 + F.call_function("shiftright", size, F.greatest(bits - 3, F.lit(0)))).cast("int")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Targets by water filling: (source, source_size, target).

    ``sizes`` has (source, source_size). Sources in code point order, null
    last, get ``weights`` in turn. They share ``share`` of all sizes by weight,
    but none more than ``most`` times its size; what is above goes to the rest
    by weight. That ends where every target is the smaller of its cap and
    weight times one common level. With sources sorted by cap over weight, the
    level that is left after capping the first ones rises as long as the next
    one is above its cap and falls afterwards, so the highest is the level
    sought: one pass instead of rounds of resharing.
    """
    everything = Window.partitionBy()
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (nth % len(weights) + 1).cast("int"))
    by_level = Window.orderBy("_full", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after)
    return (
        sizes.withColumn("_weight", weight)
        .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("_full", F.col("_cap") / F.col("_weight"))
        .withColumn("_budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(everything))
        .select("source", "source_size", F.coalesce(F.least(F.col("_cap"), F.col("_level") * F.col("_weight")), F.col("_cap")).alias("target"))
    )


def mix_plan(docs: DataFrame, *, id_column: str = "doc_id", source_column: str = "source", size: Column | None = None, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 7) -> DataFrame:
    """One row per row of ``docs``: (doc_id, size, source_size, target, copies).

    Only these columns are read, so others may have any name. A null text has
    size 0, a null source is a source of its own, a null id is placed like an
    empty one. Repeated rows are rows of their own. An empty table gives an
    empty table. Equal inputs and seed give equal plans; rows that agree in id,
    source and size are alike and may trade their copies.
    """
    rows = written(docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), (word_count(F.col("text")) if size is None else size).cast("long").alias("size")), "mix-sizes")
    rows = rows.withColumn("_class", size_class(F.col("size"))).withColumn("_salt", hash_bucket(F.col("doc_id"), SALTS))
    cell = ["source", "_class", "_salt"]
    cells = rows.groupBy(*cell).agg(F.count("*").alias("_n"), F.sum("size").alias("_size"))
    sources = source_targets(cells.groupBy("source").agg(F.sum("_size").alias("source_size")), weights, share, most)
    starts = cells.select(*cell, (F.sum("_n").over(Window.partitionBy("source").orderBy("_class", "_salt")) - F.col("_n")).alias("_start"))
    starts = starts.alias("c").join(sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select(*[F.col(f"c.{c}") for c in [*cell, "_start"]], "source_size", "target")
    numbered = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*cell).orderBy("size", "doc_id")))
    same = F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r._class") == F.col("c._class")) & (F.col("r._salt") == F.col("c._salt"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = hash_unit(F.lit(str(seed)), F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull().cast("string"))
    joined = numbered.alias("r").join(starts.alias("c"), same).select("doc_id", F.col("r.source").alias("source"), "size", "source_size", "target", (F.col("_start") + F.col("_nth")).alias("_at"))
    joined = joined.withColumn("_rate", rate).withColumn("_offset", offset)
    upto = lambda at: F.floor(at * F.col("_rate") + F.col("_offset"))
    return joined.select("doc_id", "source", "size", "source_size", "target", (upto(F.col("_at")) - upto(F.col("_at") - 1)).cast("long").alias("copies"))


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as :func:`mix_plan` says.

    Ids must tell rows apart as far as their copies matter; rows that share an
    id, source and size pool their copies and each gets the same share, the
    first ones one more. Null ids, sources and texts are values of their own.
    Columns are those of ``docs``, whatever their names; an empty table gives
    an empty table.
    """
    id_column, source_column = str(options.get("id_column", "doc_id")), str(options.get("source_column", "source"))
    plan = mix_plan(docs, **options)  # type: ignore[arg-type]
    key = ["doc_id", "source", "size"]
    wanted = plan.groupBy(*key).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0")
    size = options.get("size")
    # columns take plain names of their own; both ways below read the same ones, so that texts travel once
    own = [f"c{k}" for k in range(len(docs.columns))]
    at = dict(zip(docs.columns, own, strict=True))
    words = (word_count(F.col("text")) if size is None else size).cast("long")  # type: ignore[attr-defined]
    named = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in at.items()], F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), words.alias("size"))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"w.{c}")) for c in key]
    out = named.alias("d").join(wanted.alias("w"), same).select(*[f"d.{c}" for c in named.columns], "w.copies", "w.rows")
    alike = Window.partitionBy(*key).orderBy(at["text"])
    shared = out.where("rows > 1").withColumn("nth", F.row_number().over(alike)).withColumn("copies", F.expr("copies div rows + int(nth <= copies % rows)")).drop("nth")
    out = out.where("rows = 1").unionByName(shared).where("copies > 0")
    return out.select(*own, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*own).toDF(*docs.columns)
