"""The catalogue: each entry applies an operator to the tables, with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lattica.operators import introspect, pattern, write
from lattica.operators.graph import EDGE_KEY, NODE_KEY, Graph, edge_rows
from lattica.plans.projection import ANCESTORS, EDGE_FIELDS, UNIVERSE, graph

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- scans, filters, expansion ---------------------------------------------


@query("SELECT c_custkey::VARCHAR AS id, c_name AS name, c_acctbal AS acctbal FROM customer WHERE c_acctbal >= 5000 AND c_mktsegment IS NOT NULL")
def label_scan_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer",), ("IN_REGION",))
    rows = pattern.scan(g, "c", "Customer", (F.col("props.acctbal") >= 5000) & F.col("props.segment").isNotNull())
    return rows.select("c.id", "c.name", "c.props.acctbal")


@query("SELECT n_name AS nation, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def expand_1hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Nation", "Region"), ("IN_REGION",))
    return pattern.expand(g, pattern.scan(g, "n", "Nation"), "n", "IN_REGION", "r").select(F.col("n.name").alias("nation"), F.col("r.name").alias("region"))


@query("SELECT r_name AS region, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def expand_2hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer", "Nation", "Region"), ("IN_NATION", "IN_REGION"))
    rows = pattern.expand(g, pattern.scan(g, "c", "Customer"), "c", "IN_NATION", "n", label="Nation")
    rows = pattern.expand(g, rows, "n", "IN_REGION", "r")
    return rows.groupBy(F.col("r.name").alias("region")).agg(F.count("*").alias("customers"))


@query("SELECT o_orderkey::VARCHAR AS order_id, n_name AS nation FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 300000")
def expand_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Order", "Customer", "Nation"), ("PLACED", "IN_NATION"))
    rows = pattern.expand(g, pattern.scan(g, "o", "Order", F.col("props.total") > 300000), "o", "PLACED", "c", direction="in")
    return pattern.expand(g, rows, "c", "IN_NATION", "n").select(F.col("o.id").alias("order_id"), F.col("n.name").alias("nation"))


@query("SELECT o_orderkey::VARCHAR AS order_id, c_name AS customer, p_name AS part FROM orders JOIN customer ON o_custkey = c_custkey JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey")
def multi_pattern_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Order", "Customer", "Part"), ("PLACED", "CONTAINS"))
    rows = pattern.expand(g, pattern.scan(g, "p", "Part"), "p", "CONTAINS", "o", direction="in")
    rows = pattern.expand(g, rows, "o", "PLACED", "c", direction="in")
    return rows.select(F.col("o.id").alias("order_id"), F.col("c.name").alias("customer"), F.col("p.name").alias("part"))


@query("WITH e AS (SELECT DISTINCT l_partkey p, l_suppkey s FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part)) SELECT a.p::VARCHAR AS part_id, a.s::VARCHAR AS first_id, b.s::VARCHAR AS second_id FROM e a JOIN e b ON a.p = b.p AND a.s <> b.s")
def self_pattern_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Part", "Supplier"), ("SUPPLIED_BY",))
    rows = pattern.scan(g, "p", "Part")
    rows = pattern.expand_keys(g, rows, "p", "SUPPLIED_BY", "a")
    rows = pattern.expand_keys(g, rows, "p", "SUPPLIED_BY", "b").where("a.id <> b.id")
    return rows.select(F.col("p.id").alias("part_id"), F.col("a.id").alias("first_id"), F.col("b.id").alias("second_id"))


@query("SELECT c_custkey::VARCHAR AS customer_id, o_orderkey::VARCHAR AS order_id FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'")
def optional_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer", "Order"), ("PLACED",))
    rows = pattern.expand(g, pattern.scan(g, "c", "Customer"), "c", "PLACED", "o", where=F.col("props.status") == "F", label="Order", optional=True)
    return rows.select(F.col("c.id").alias("customer_id"), F.col("o.id").alias("order_id"))


def _large_orders(spark: SparkSession, sf_dir: str) -> Graph:
    """Customers, and edges to their large orders only."""
    g = graph(spark, sf_dir, ("Customer",), ("PLACED",))
    large = _read(spark, sf_dir, "orders").where("o_totalprice > 380000").select(F.col("o_orderkey").cast("string").alias("dst_id"))
    return Graph(g.nodes, g.edges.join(large, "dst_id", "left_semi").select(*EDGE_KEY, "props"))


@query("SELECT c_custkey::VARCHAR AS id FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 380000)")
def anti_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _large_orders(spark, sf_dir)
    return pattern.without(g, pattern.scan(g, "c", "Customer"), "c", "PLACED").select("c.id")


@query("SELECT s_suppkey::VARCHAR AS id FROM supplier s WHERE NOT EXISTS (SELECT 1 FROM supplier o WHERE o.s_nationkey = s.s_nationkey AND o.s_suppkey <> s.s_suppkey AND o.s_acctbal > s.s_acctbal)")
def not_exists_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Supplier", "Nation"), ("IN_NATION",))
    rows = pattern.expand_keys(g, pattern.scan(g, "s", "Supplier"), "s", "IN_NATION", "n")
    return pattern.without_greater(rows, "n", F.col("s.props.acctbal")).select("s.id")


@query("WITH e AS (SELECT DISTINCT l_partkey p, l_suppkey s FROM lineitem) SELECT DISTINCT a.s::VARCHAR AS id, b.s::VARCHAR AS other FROM e a JOIN e b ON a.p = b.p AND a.s <> b.s WHERE NOT EXISTS (SELECT 1 FROM supplier x JOIN supplier y ON x.s_nationkey = y.s_nationkey WHERE x.s_suppkey = a.s AND y.s_suppkey = b.s)")
def not_exists_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that share a part and no nation."""
    g = graph(spark, sf_dir, ("Nation",), ("IN_NATION",))
    supplied = edge_rows(_read(spark, sf_dir, "lineitem"), UNIVERSE, "SUPPLIED_BY", ("Part", F.col("l_partkey")), ("Supplier", F.col("l_suppkey")), {}, EDGE_FIELDS)  # an edge for each line: repeated ones count once
    pairs = pattern.pairs_apart(Graph(g.nodes, g.edges.unionByName(supplied)), "Supplier", ("SUPPLIED_BY", "in"), ("IN_NATION", "out"), "s", "o")
    return pairs.select("s.id", F.col("o.id").alias("other"))


@query("SELECT c_custkey::VARCHAR AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 380000)")
def orphan_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.orphans(_large_orders(spark, sf_dir)).select("id")


@query("SELECT DISTINCT (l_partkey + 100)::VARCHAR AS id FROM lineitem WHERE l_partkey + 100 NOT IN (SELECT p_partkey FROM part)")
def missing_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _read(spark, sf_dir, "lineitem").select(F.lit(UNIVERSE).alias("universe"), F.lit("Part").alias("key_label"), (F.col("l_partkey") + 100).cast("string").alias("id")).distinct()
    return introspect.missing_nodes(graph(spark, sf_dir, ("Part",), ("PLACED",)), wanted).select("id")


@query("SELECT o_custkey::VARCHAR AS id, count(*) AS orders FROM orders GROUP BY o_custkey HAVING count(*) >= 20")
def degree_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer",), ("PLACED",))
    return pattern.degree(g, "PLACED", least=20).select("id", F.col("n").alias("orders"))


@query("SELECT DISTINCT s_nationkey::VARCHAR AS nation_id FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey")
def distinct_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Part", "Supplier", "Nation"), ("SUPPLIED_BY", "IN_NATION"))
    rows = pattern.expand_keys(g, pattern.scan(g, "p", "Part"), "p", "SUPPLIED_BY", "s")
    return pattern.expand_keys(g, rows, "s", "IN_NATION", "n").select(F.col("n.id").alias("nation_id")).distinct()


@query("SELECT n_name AS nation, r_name AS region, s_name AS supplier FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_acctbal > 0")
def chain_3hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Supplier", "Nation", "Region"), ("IN_NATION", "IN_REGION"))
    rows = pattern.expand(g, pattern.scan(g, "s", "Supplier", F.col("props.acctbal") > 0), "s", "IN_NATION", "n", label="Nation")
    rows = pattern.expand(g, rows, "n", "IN_REGION", "r")
    return rows.select(F.col("n.name").alias("nation"), F.col("r.name").alias("region"), F.col("s.name").alias("supplier"))


@query("SELECT id, total FROM (SELECT o_orderkey::VARCHAR AS id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS total FROM orders) ORDER BY total DESC NULLS FIRST, id LIMIT 10")
def topk_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pattern.scan(graph(spark, sf_dir, ("Order",), ("PLACED",)), "o", "Order")
    rows = rows.select("o.id", F.when(F.col("o.props.status") != "P", F.col("o.props.total")).alias("total"))
    return pattern.top(rows, F.col("total"), F.col("id"), 10)


@query("SELECT nation, id, rank FROM (SELECT c_nationkey::VARCHAR AS nation, c_custkey::VARCHAR AS id, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey::VARCHAR) AS rank FROM customer) WHERE rank <= 3")
def topk_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer",), ("IN_NATION",))
    rows = pattern.expand_keys(g, pattern.scan(g, "c", "Customer"), "c", "IN_NATION", "n")
    w = Window.partitionBy("n.id").orderBy(F.desc("c.props.acctbal"), "c.id")
    return rows.select(F.col("n.id").alias("nation"), "c.id", F.row_number().over(w).cast("long").alias("rank")).where("rank <= 3")


_LOCATED = "WITH RECURSIVE e AS (SELECT 'c' || c_custkey AS a, 'n' || c_nationkey AS b FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation), walk AS (SELECT a AS start, a AS node, 0 AS depth FROM (SELECT 'c' || c_custkey AS a FROM customer) UNION ALL SELECT start, b, depth + 1 FROM walk JOIN e ON node = a) "


def _located(spark: SparkSession, sf_dir: str, least: int) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer", "Nation", "Region"), ("IN_NATION", "IN_REGION"))
    rows = pattern.reach(g, pattern.scan(g, "c", "Customer"), "c", ["IN_NATION", "IN_REGION"], "x", least=least, most=5)
    return rows.select(F.col("c.id").alias("customer_id"), F.col("x.key_label").alias("label"), F.col("x.id").alias("id"), F.col("depth").cast("long").alias("depth"))


@query(_LOCATED + "SELECT substr(start, 2) AS customer_id, CASE substr(node, 1, 1) WHEN 'n' THEN 'Nation' ELSE 'Region' END AS label, substr(node, 2) AS id, depth::BIGINT AS depth FROM walk WHERE depth >= 1")
def transitive_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _located(spark, sf_dir, 1)


@query(_LOCATED + "SELECT substr(start, 2) AS customer_id, CASE substr(node, 1, 1) WHEN 'c' THEN 'Customer' WHEN 'n' THEN 'Nation' ELSE 'Region' END AS label, substr(node, 2) AS id, depth::BIGINT AS depth FROM walk")
def reach_zero_or_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _located(spark, sf_dir, 0)


# --- introspection ---------------------------------------------------------

_COUNTS = "SELECT 'Region' leaf, count(*) n FROM region UNION ALL SELECT 'Nation', count(*) FROM nation UNION ALL SELECT 'Customer', count(*) FROM customer UNION ALL SELECT 'Supplier', count(*) FROM supplier UNION ALL SELECT 'Part', count(*) FROM part UNION ALL SELECT 'Order', count(*) FROM orders UNION ALL SELECT 'User', count(DISTINCT user_id) FROM events UNION ALL SELECT 'EventType', count(DISTINCT event_type) FROM events"


@query(f"WITH l AS ({_COUNTS}) SELECT label, sum(n)::BIGINT AS n FROM (SELECT leaf AS label, n FROM l UNION ALL SELECT 'Entity', n FROM l UNION ALL SELECT CASE WHEN leaf IN ('Region', 'Nation') THEN 'Location' WHEN leaf IN ('Customer', 'Supplier', 'User') THEN 'Agent' WHEN leaf = 'Part' THEN 'Object' WHEN leaf = 'Order' THEN 'Event' ELSE 'Concept' END, n FROM l) GROUP BY label")
def label_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.count_labels(graph(spark, sf_dir))


@query(_COUNTS)
def leaf_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.count_leaves(graph(spark, sf_dir), ANCESTORS)


@query(
    "SELECT 'Nation' start_leaf, 'IN_REGION' AS type, 'Region' end_leaf, count(*) n FROM nation UNION ALL SELECT 'Customer', 'IN_NATION', 'Nation', count(*) FROM customer UNION ALL SELECT 'Supplier', 'IN_NATION', 'Nation', count(*) FROM supplier UNION ALL SELECT 'Customer', 'PLACED', 'Order', count(*) FROM orders JOIN customer ON o_custkey = c_custkey"
)
def pattern_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.count_patterns(graph(spark, sf_dir, ("Region", "Nation", "Customer", "Supplier", "Order"), ("IN_REGION", "IN_NATION", "PLACED")))


@query("SELECT 'IN_NATION' AS type, count(*) n FROM (SELECT c_custkey FROM customer UNION ALL SELECT s_suppkey FROM supplier) UNION ALL SELECT 'PLACED', count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)")
def rel_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # orders are not in this graph: edges to them count all the same
    return introspect.count_types(graph(spark, sf_dir, ("Customer", "Supplier"), ("IN_NATION", "PLACED")))


@query(
    "SELECT 'Customer' leaf, 'acctbal' property, 'double' AS type, count(c_acctbal) n, count(c_acctbal) = count(*) mandatory FROM customer UNION ALL SELECT 'Customer', 'segment', 'string', count(c_mktsegment), count(c_mktsegment) = count(*) FROM customer UNION ALL SELECT 'Supplier', 'acctbal', 'double', count(s_acctbal), count(s_acctbal) = count(*) FROM supplier UNION ALL SELECT 'Part', 'brand', 'string', count(p_brand), count(p_brand) = count(*) FROM part UNION ALL SELECT 'Part', 'kind', 'string', count(p_type), count(p_type) = count(*) FROM part UNION ALL SELECT 'Part', 'size', 'int', count(p_size), count(p_size) = count(*) FROM part UNION ALL SELECT 'Part', 'price', 'double', count(p_retailprice), count(p_retailprice) = count(*) FROM part"
)
def property_mandatory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.property_shapes(graph(spark, sf_dir, ("Customer", "Supplier", "Part"), ("IN_NATION",)))


@query("WITH v AS (SELECT DISTINCT 'Customer' leaf, 'segment' property, c_mktsegment AS value FROM customer UNION SELECT DISTINCT 'Part', 'brand', p_brand FROM part UNION SELECT DISTINCT 'Part', 'kind', p_type FROM part) SELECT leaf, property, value FROM v WHERE value IS NOT NULL AND (leaf, property) IN (SELECT (leaf, property) FROM v GROUP BY leaf, property HAVING count(value) <= 30)")
def enum_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.enum_values(graph(spark, sf_dir, ("Customer", "Part"), ("IN_NATION",)))


@query("SELECT 'IN_NATION' AS type, (SELECT count(*) FROM supplier) start_faults, 0::BIGINT end_faults, (SELECT min(s_suppkey::VARCHAR) FROM supplier) start_sample, NULL::VARCHAR end_sample UNION ALL SELECT 'IN_REGION', 0, (SELECT count(*) FROM nation), NULL, (SELECT min(n_regionkey::VARCHAR) FROM nation)")
def edge_typing_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Region", "Nation", "Customer", "Supplier"), ("IN_REGION", "IN_NATION"))
    domains = spark.createDataFrame([("IN_NATION", ["Customer"], ["Location"]), ("IN_REGION", ["Location"], ["Agent"])], "type string, start_labels array<string>, end_labels array<string>")
    return introspect.edge_typing_faults(g, domains)


@query("SELECT c_nationkey::VARCHAR AS key, count(*) AS n, string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey::VARCHAR) AS owners FROM customer GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("key"), F.col("c_custkey").cast("string").alias("owner"))
    return write.duplicate_keys(rows, ["key"], "owner").select("key", "n", F.array_join("owners", ",").alias("owners"))


# --- writes ----------------------------------------------------------------


def _props(g: Graph, **values: F.Column) -> F.Column:
    return F.struct(*[(values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name) for f in g.nodes.schema["props"].dataType.fields])


def _batch(g: Graph, rows: DataFrame, leaf: str, id_: F.Column, name: F.Column, **values: F.Column) -> DataFrame:
    return rows.select(F.lit(UNIVERSE).alias("universe"), F.lit(leaf).alias("key_label"), id_.cast("string").alias("id"), F.lit(leaf).alias("leaf"), F.array(*map(F.lit, [leaf, *ANCESTORS[leaf]])).alias("labels"), name.cast("string").alias("name"), _props(g, **values).alias("props"))


@query(
    "SELECT coalesce(n.id, o.id) AS id, coalesce(n.name, o.name) AS name, coalesce(n.acctbal, o.acctbal) AS acctbal, o.segment AS segment, 'Customer|Agent|Entity' AS labels FROM (SELECT c_custkey::VARCHAR id, c_name AS name, c_acctbal acctbal, c_mktsegment segment FROM customer) o FULL JOIN (SELECT (s_suppkey * 37)::VARCHAR id, s_name AS name, s_acctbal acctbal FROM supplier) n ON n.id = o.id"
)
def upsert_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer",), ("PLACED",))
    batch = _batch(g, _read(spark, sf_dir, "supplier"), "Customer", F.col("s_suppkey") * 37, F.col("s_name"), acctbal=F.col("s_acctbal"))
    return write.merge_nodes(g.nodes, batch, list(ANCESTORS)).select("id", "name", "props.acctbal", "props.segment", F.array_join("labels", "|").alias("labels"))


@query("SELECT c_custkey::VARCHAR AS id, c_name AS name FROM customer UNION ALL SELECT DISTINCT (o_custkey + 3)::VARCHAR, 'stub' FROM orders WHERE o_custkey + 3 NOT IN (SELECT c_custkey FROM customer)")
def stub_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer",), ("PLACED",))
    rows = _read(spark, sf_dir, "orders").select((F.col("o_custkey") + 3).alias("k")).distinct()
    return write.insert_stubs(g.nodes, _batch(g, rows, "Customer", F.col("k"), F.lit("stub"))).select("id", "name")


@query(
    "WITH o AS (SELECT l_orderkey a, l_partkey b, round(sum(l_quantity), 2) q, count(*) n FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1, 2), w AS (SELECT DISTINCT l_orderkey a, l_partkey b, 999 n FROM lineitem WHERE l_linenumber >= 3 AND l_orderkey IN (SELECT o_orderkey FROM orders) AND l_partkey IN (SELECT p_partkey FROM part)) SELECT coalesce(o.a, w.a)::VARCHAR AS src_id, coalesce(o.b, w.b)::VARCHAR AS dst_id, q AS quantity, coalesce(w.n, o.n)::BIGINT AS count FROM o FULL JOIN w ON o.a = w.a AND o.b = w.b"
)
def edge_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lattica.operators.graph import edge_rows
    from lattica.plans.projection import EDGE_FIELDS

    lines = _read(spark, sf_dir, "lineitem")
    nodes = graph(spark, sf_dir, ("Order", "Part"), ("PLACED",)).nodes
    old = lines.where("l_linenumber <= 3").groupBy("l_orderkey", "l_partkey").agg(F.sum("l_quantity").alias("q"), F.count("*").alias("n"))
    new = lines.where("l_linenumber >= 3").select("l_orderkey", "l_partkey").distinct()
    ends = {"src": ("Order", F.col("l_orderkey")), "dst": ("Part", F.col("l_partkey"))}
    g = Graph(nodes, edge_rows(old, UNIVERSE, "CONTAINS", ends["src"], ends["dst"], {"quantity": F.col("q"), "count": F.col("n")}, EDGE_FIELDS))
    merged = write.merge_edges(g, edge_rows(new, UNIVERSE, "CONTAINS", ends["src"], ends["dst"], {"count": F.lit(999)}, EDGE_FIELDS))
    return merged.select("src_id", "dst_id", F.round("props.quantity", 2).alias("quantity"), "props.count")


@query("SELECT c_custkey::VARCHAR AS id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 380000)")
def sync_prune_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer",), ("IN_NATION",))
    listed = _read(spark, sf_dir, "orders").where("o_totalprice > 380000").select(F.lit(UNIVERSE).alias("universe"), F.lit("Customer").alias("key_label"), F.col("o_custkey").cast("string").alias("id")).distinct()
    return write.prune_nodes(g, ["Customer"], listed).nodes.select("id")


@query("SELECT c_custkey::VARCHAR AS src_id, c_nationkey::VARCHAR AS dst_id FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT s_suppkey::VARCHAR, s_nationkey::VARCHAR FROM supplier")
def sync_prune_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer", "Nation", "Supplier"), ("IN_NATION",))
    rich = _read(spark, sf_dir, "customer").where("c_acctbal >= 0")
    from lattica.operators.graph import edge_rows
    from lattica.plans.projection import EDGE_FIELDS

    listed = edge_rows(rich, UNIVERSE, "IN_NATION", ("Customer", F.col("c_custkey")), ("Nation", F.col("c_nationkey")), {}, EDGE_FIELDS)
    return write.prune_edges(g, ["Customer", "Nation"], listed).select("src_id", "dst_id")


@query("SELECT o_custkey::VARCHAR AS src_id, o_orderkey::VARCHAR AS dst_id FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING' OR o_orderstatus = 'F'")
def claim_prune_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer", "Order"), ("PLACED",))
    customers, orders = _read(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'"), _read(spark, sf_dir, "orders")
    claims = customers.select(F.lit(UNIVERSE).alias("universe"), F.lit("Customer").alias("anchor_label"), F.col("c_custkey").cast("string").alias("anchor_id"), F.lit("PLACED").alias("type"), F.lit(None).cast("string").alias("other_label"), F.lit(False).alias("owns_other_end"))
    kept = orders.where("o_orderstatus = 'F'").select(F.lit(UNIVERSE).alias("universe"), F.lit("PLACED").alias("type"), F.lit("Customer").alias("anchor_label"), F.col("o_custkey").cast("string").alias("anchor_id"), F.lit("Order").alias("other_label"), F.col("o_orderkey").cast("string").alias("other_id"))
    return write.prune_claims(g, claims, kept, g.nodes.limit(0), "out").edges.select("src_id", "dst_id")


@query("SELECT c_custkey::VARCHAR AS id FROM customer WHERE c_nationkey <> 3 OR c_acctbal >= 1000 OR c_mktsegment = 'MACHINERY'")
def claim_prune_in_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer", "Nation"), ("IN_NATION",))
    claims = spark.createDataFrame([(UNIVERSE, "Nation", "3", "IN_NATION", "Customer", True)], "universe string, anchor_label string, anchor_id string, type string, other_label string, owns_other_end boolean")
    rows = _read(spark, sf_dir, "customer")
    kept = rows.where("c_acctbal >= 1000").select(F.lit(UNIVERSE).alias("universe"), F.lit("IN_NATION").alias("type"), F.lit("Nation").alias("anchor_label"), F.col("c_nationkey").cast("string").alias("anchor_id"), F.lit("Customer").alias("other_label"), F.col("c_custkey").cast("string").alias("other_id"))
    owners = rows.where("c_mktsegment = 'MACHINERY'").select(F.lit(UNIVERSE).alias("universe"), F.lit("Customer").alias("key_label"), F.col("c_custkey").cast("string").alias("id"))
    return write.prune_claims(g, claims, kept, owners, "in").nodes.where("key_label = 'Customer'").select("id")


@query("SELECT 0::BIGINT AS shop_nodes, count(*) AS other_nodes FROM region")
def purge_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Region", "Nation"), ("IN_REGION",))
    other = g.nodes.where("key_label = 'Region'").withColumn("universe", F.lit("other"))
    left = write.purge(Graph(g.nodes.unionByName(other), g.edges), UNIVERSE)
    return left.nodes.agg(F.count_if(F.col("universe") == UNIVERSE).alias("shop_nodes"), F.count_if(F.col("universe") == "other").alias("other_nodes"))


@query("SELECT 0::BIGINT AS created, 0::BIGINT AS deleted, count(*) AS kept FROM customer")
def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer",), ("PLACED",))
    return write.counters(g.nodes, write.merge_nodes(g.nodes, g.nodes, list(ANCESTORS)), NODE_KEY)


@query("SELECT 'x' || l_partkey AS id, min(l_orderkey) AS seq FROM lineitem GROUP BY 1")
def dedupe_owner_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_orderkey").agg(F.count("*").alias("n"))
    nodes = rows.select(F.lit(UNIVERSE).alias("universe"), F.lit("Part").alias("key_label"), F.concat(F.lit("x"), F.col("l_partkey")).alias("id"), F.lit(True).alias("is_owner"), F.col("l_orderkey").alias("seq"))
    return write.dedupe_owners(nodes).select("id", "seq")


@query("SELECT o_custkey::VARCHAR AS src_id, count(*) AS n FROM orders GROUP BY 1")
def edge_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer", "Order"), ("PLACED",))
    return g.edges.dropDuplicates(EDGE_KEY).groupBy("src_id").agg(F.count("*").alias("n"))
