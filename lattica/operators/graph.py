"""The property graph: two DataFrames, scoped by universe.

nodes: universe, key_label, id, leaf, labels, name, props (a struct)
edges: universe, type, src_label, src_id, dst_label, dst_id, props (a struct)

A node is found by universe, id and one of its labels; an edge's identity is
its type and its two ends.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODE_KEY = ["universe", "key_label", "id"]
EDGE_KEY = ["universe", "type", "src_label", "src_id", "dst_label", "dst_id"]


@dataclass(frozen=True)
class Graph:
    nodes: DataFrame
    edges: DataFrame

    def in_universe(self, universe: str) -> Graph:
        """Nodes of one universe and edges between them; a partition filter where the tables are partitioned."""
        return Graph(self.nodes.where(F.col("universe") == universe), self.edges.where(F.col("universe") == universe))


def has_label(label: str, column: str = "labels") -> Column:
    return F.array_contains(F.col(column), label)


def node_rows(df: DataFrame, universe: str, labels: Sequence[str], id_: Column, name: Column, props: Mapping[str, Column], fields: Mapping[str, str]) -> DataFrame:
    """Rows of a table as nodes: ``labels`` are the leaf and its ancestors, ``fields`` all property names and types of the graph."""
    values = [(props[f] if f in props else F.lit(None)).cast(t).alias(f) for f, t in fields.items()]
    return df.select(
        F.lit(universe).alias("universe"),
        F.lit(labels[0]).alias("key_label"),
        id_.cast("string").alias("id"),
        F.lit(labels[0]).alias("leaf"),
        F.array(*map(F.lit, labels)).alias("labels"),
        name.cast("string").alias("name"),
        F.struct(*values).alias("props"),
    )


def edge_rows(df: DataFrame, universe: str, type_: str, src: tuple[str, Column], dst: tuple[str, Column], props: Mapping[str, Column], fields: Mapping[str, str]) -> DataFrame:
    values = [(props[f] if f in props else F.lit(None)).cast(t).alias(f) for f, t in fields.items()]
    return df.select(
        F.lit(universe).alias("universe"),
        F.lit(type_).alias("type"),
        F.lit(src[0]).alias("src_label"),
        src[1].cast("string").alias("src_id"),
        F.lit(dst[0]).alias("dst_label"),
        dst[1].cast("string").alias("dst_id"),
        F.struct(*values).alias("props"),
    )


def merge_structs(new: Column, old: Column, fields: Sequence[str]) -> Column:
    """Field by field the new value, or the old one where there is none: a missing value never clears one."""
    return F.struct(*[F.coalesce(new[f], old[f]).alias(f) for f in fields])


def struct_fields(df: DataFrame, column: str) -> list[str]:
    return [f.name for f in df.schema[column].dataType.fields]


def is_stub(df: DataFrame) -> Column:
    """Whether a node has no property besides id and name."""
    return F.coalesce(*[F.col(f"props.{f}").cast("string") for f in struct_fields(df, "props")], F.lit(None)).isNull()
