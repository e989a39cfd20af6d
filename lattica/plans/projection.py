"""A property graph from order, event and document tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.operators.graph import Graph, edge_rows, node_rows

UNIVERSE = "shop"

#: Each class and its ancestors.
ANCESTORS: dict[str, list[str]] = {
    "Entity": [],
    "Location": ["Entity"],
    "Agent": ["Entity"],
    "Object": ["Entity"],
    "Event": ["Entity"],
    "Concept": ["Entity"],
    "Region": ["Location", "Entity"],
    "Nation": ["Location", "Entity"],
    "Customer": ["Agent", "Entity"],
    "Supplier": ["Agent", "Entity"],
    "Part": ["Object", "Entity"],
    "Order": ["Event", "Entity"],
    "User": ["Agent", "Entity"],
    "EventType": ["Concept", "Entity"],
}

NODE_FIELDS = {"acctbal": "double", "segment": "string", "brand": "string", "kind": "string", "size": "int", "price": "double", "status": "string", "total": "double", "priority": "string", "ordered": "timestamp"}
EDGE_FIELDS = {"quantity": "double", "price": "double", "count": "bigint"}

_LEAVES = ("Region", "Nation", "Customer", "Supplier", "Part", "Order", "User", "EventType")
_TYPES = ("IN_REGION", "IN_NATION", "PLACED", "CONTAINS", "SUPPLIED_BY", "DID")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nodes(spark: SparkSession, sf_dir: str, leaf: str) -> DataFrame:
    c = F.col
    of = {
        "Region": ("region", c("r_regionkey"), c("r_name"), {}),
        "Nation": ("nation", c("n_nationkey"), c("n_name"), {}),
        "Customer": ("customer", c("c_custkey"), c("c_name"), {"acctbal": c("c_acctbal"), "segment": c("c_mktsegment")} if leaf == "Customer" else {}),
        "Supplier": ("supplier", c("s_suppkey"), c("s_name"), {"acctbal": c("s_acctbal")}),
        "Part": ("part", c("p_partkey"), c("p_name"), {"brand": c("p_brand"), "kind": c("p_type"), "size": c("p_size"), "price": c("p_retailprice")}),
        "Order": ("orders", c("o_orderkey"), c("o_orderkey"), {"status": c("o_orderstatus"), "total": c("o_totalprice"), "priority": c("o_orderpriority"), "ordered": c("o_orderdate")}),
    }
    if leaf in of:
        table, id_, name, props = of[leaf]
        rows = _read(spark, sf_dir, table)
    else:
        column = "user_id" if leaf == "User" else "event_type"
        rows, id_, name, props = _read(spark, sf_dir, "events").select(column).distinct(), c(column), c(column), {}
    return node_rows(rows, UNIVERSE, [leaf, *ANCESTORS[leaf]], id_, name, props, NODE_FIELDS)


def _edges(spark: SparkSession, sf_dir: str, type_: str) -> DataFrame:
    c = F.col
    make = lambda rows, src, dst, props={}: edge_rows(rows, UNIVERSE, type_, src, dst, props, EDGE_FIELDS)
    if type_ == "IN_REGION":
        return make(_read(spark, sf_dir, "nation"), ("Nation", c("n_nationkey")), ("Region", c("n_regionkey")))
    if type_ == "IN_NATION":
        customers = make(_read(spark, sf_dir, "customer"), ("Customer", c("c_custkey")), ("Nation", c("c_nationkey")))
        return customers.unionByName(make(_read(spark, sf_dir, "supplier"), ("Supplier", c("s_suppkey")), ("Nation", c("s_nationkey"))))
    if type_ == "PLACED":
        return make(_read(spark, sf_dir, "orders"), ("Customer", c("o_custkey")), ("Order", c("o_orderkey")))
    lines = _read(spark, sf_dir, "lineitem")
    if type_ == "CONTAINS":
        pairs = lines.groupBy("l_orderkey", "l_partkey").agg(F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("p"), F.count("*").alias("n"))
        return make(pairs, ("Order", c("l_orderkey")), ("Part", c("l_partkey")), {"quantity": c("q"), "price": c("p"), "count": c("n")})
    if type_ == "SUPPLIED_BY":
        return make(lines.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n")), ("Part", c("l_partkey")), ("Supplier", c("l_suppkey")), {"count": c("n")})
    return make(_read(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n")), ("User", c("user_id")), ("EventType", c("event_type")), {"count": c("n")})


def graph(spark: SparkSession, sf_dir: str, leaves: tuple[str, ...] = _LEAVES, types: tuple[str, ...] = _TYPES) -> Graph:
    """The projection, or the part of it with these leaf classes and edge types; what a query doesn't name isn't read."""
    nodes = reduce(DataFrame.unionByName, [_nodes(spark, sf_dir, x) for x in leaves])
    return Graph(nodes, reduce(DataFrame.unionByName, [_edges(spark, sf_dir, x) for x in types]))
