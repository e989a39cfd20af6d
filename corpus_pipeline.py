"""A training corpus from ``documents``, stage by stage.

Each stage takes the rows that the one before kept and returns a DataFrame,
which is written as Parquet and read again as the next one's input. All but
the last return the columns of ``documents``; the last adds where rows lie, and
its files are those of the shards, one folder each.

Null and empty texts aren't toxic, near copies or contaminated, and weigh
nothing in the mix, so that it leaves them out unless their source's rate keeps
them; rows without an id are kept like others. Repeated rows are near copies of
each other. Empty tables pass every stage as empty tables. Columns beside those
of ``documents``, whatever their names, go through all stages.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm import decontam, jaccard, mixing, sharding, toxicity
from lattica.llm.common import discard, documents, shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: No single SQL statement trains the classifier and solves the flow.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.score_udf(model)(F.col("text")) < toxicity.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id."""
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than a twentieth, or nothing."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix with each row's size, shard and slot, among shards of near equal bytes."""
    return sharding.reshard(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; their tables go to the shared folder, and each goes when the next one stands."""
    docs, before = documents(spark, sf_dir), None
    base = f"{shared_dir(spark)}/lattica/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        writer = out.write.partitionBy("shard") if name == STAGES[-1][0] else out.write
        writer.parquet(f"{base}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{name}")
        if before:
            discard(spark, before)
        before = f"{base}/{name}"
    return docs
