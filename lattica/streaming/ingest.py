"""Streams into the graph. The batch engine has no streams; this goes beyond parity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lattica.operators.graph import NODE_KEY, Graph
from lattica.operators.write import duplicate_keys, merge_nodes
from lattica.sources.tables import commit_graph, current_version, read_graph


def event_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events by type and tumbling window; those later than ``late`` behind the newest don't count in a stream."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    counted = rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def ingest_nodes(stream: DataFrame, root: str, ontology_labels: list[str], checkpoint: str, check: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Upserts micro-batches of nodes into the graph at ``root``, each as a new snapshot.

    A batch that repeats keys or that ``check`` finds violations in is refused
    as a whole, and what was found is kept at ``root``/refused. A batch that is replayed after a
    failure changes nothing, since merging is idempotent. If another writer
    commits meanwhile, the batch fails and is replayed on what that one wrote.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        if batch.isEmpty():
            return
        for reason in (lambda rows: duplicate_keys(rows, NODE_KEY, "leaf"), check):
            if reason is not None and not (found := reason(batch)).isEmpty():
                found.write.mode("overwrite").parquet(f"{root}/refused/batch={number}")
                return
        version = current_version(spark, root)
        old = read_graph(spark, root, version)
        commit_graph(spark, Graph(merge_nodes(old.nodes, batch, ontology_labels), old.edges), root, after=version)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
