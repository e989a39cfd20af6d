"""More of the catalogue: validation, names, text, sequences, comparisons, evaluation, events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import naming, wikitext
from lattica.operators import compare, introspect, pattern, reference, resolve, runner, sequence, shapes, validate
from lattica.operators.graph import Graph, is_stub, struct_fields
from lattica.plans.projection import ANCESTORS, UNIVERSE, graph
from lattica.plans.queries import _read, query
from lattica.sources import tables
from lattica.streaming.ingest import event_counts


def _only_ids(df: DataFrame) -> DataFrame:
    return df.select("rule_id", "id", "value")


# --- validation ------------------------------------------------------------


@query("SELECT 'M1' AS rule_id, c_custkey::VARCHAR AS id, count(o_orderkey)::VARCHAR AS value FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey HAVING count(o_orderkey) NOT BETWEEN 5 AND 15")
def cardinality_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer",), ("PLACED",))
    return _only_ids(validate.edge_count_rule(g.nodes, g.edges, "M1", "Customer", "PLACED", 5, 15))


@query("SELECT 'C1' AS rule_id, n_nationkey::VARCHAR AS id, count(s_suppkey)::VARCHAR AS value FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey HAVING count(s_suppkey) < 4")
def inverse_count_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Nation",), ("IN_NATION",))
    return _only_ids(validate.edge_count_rule(g.nodes, g.edges, "C1", "Nation", "IN_NATION", 4, None, incoming=True, other="Supplier"))


@query("SELECT 'M2' AS rule_id, p_partkey::VARCHAR AS id FROM part WHERE p_size < 5 OR p_size > 45 UNION ALL SELECT 'M3', p_partkey::VARCHAR FROM part WHERE p_retailprice > 1500")
def range_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Part",), ("IN_NATION",))
    rules = [validate.Rule("M2", "Part", "props.size", validate.in_range("props.size", 5, 45, required=True), "size"), validate.Rule("M3", "Object", "props.price", validate.in_range("props.price", None, 1500), "price")]
    return validate.run_rules(g.nodes, rules).select("rule_id", "id")


@query("SELECT 'C3' AS rule_id, c_custkey::VARCHAR AS id, c_mktsegment AS value FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def enum_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer",), ("IN_NATION",))
    return _only_ids(validate.run_rules(g.nodes, [validate.Rule("C3", "Customer", "props.segment", validate.one_of("props.segment", ["BUILDING", "MACHINERY"]), "segment")]))


@query("SELECT 'B1' AS rule_id, o_orderkey::VARCHAR AS id FROM orders WHERE (o_orderstatus = 'P') <> (o_totalprice > 200000)")
def pair_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Order",), ("PLACED",))
    nodes = g.nodes.withColumn("a", F.when(F.col("props.status") == "P", 1)).withColumn("b", F.when(F.col("props.total") > 200000, 1))
    return validate.run_rules(nodes, [validate.Rule("B1", "Order", None, validate.both_or_neither("a", "b"), "both or neither")]).select("rule_id", "id")


@query("SELECT 'X1' AS rule_id, o_orderkey::VARCHAR AS id FROM orders WHERE (CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) + (CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) <> 1")
def xone_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Order",), ("PLACED",))
    nodes = g.nodes.withColumn("a", F.when(F.col("props.status") == "O", 1)).withColumn("b", F.when(F.col("props.priority") == "1-URGENT", 1))
    return validate.run_rules(nodes, [validate.Rule("X1", "Order", None, validate.exactly_one("a", "b"), "exactly one")]).select("rule_id", "id")


@query("WITH e AS (SELECT user_id u, event_type t FROM events WHERE event_type IN ('click', 'purchase', 'view')) SELECT 'K1' AS rule_id, u::VARCHAR AS id, '0' AS value FROM e GROUP BY u HAVING count(DISTINCT t) > 2")
def pairwise_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "events").select(F.lit("User").alias("src_label"), F.col("user_id").cast("string").alias("src_id"), F.lit("0").alias("dst_id"), F.col("event_type").alias("type"))
    return _only_ids(validate.pair_types_rule(rows, "K1", ["click", "purchase", "view"], 2))


@query("SELECT 'T1' AS rule_id, s_suppkey::VARCHAR AS id, 'IN_NATION' AS value FROM supplier")
def edge_typing_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Customer", "Supplier", "Nation"), ("IN_NATION",))
    ontology = validate.Ontology({k: frozenset(v) for k, v in ANCESTORS.items()}, {"IN_NATION": frozenset(["Customer"])}, {"IN_NATION": frozenset(["Location"])})
    return _only_ids(validate.check_edge_typing(g.nodes, g.edges, ontology))


@query("SELECT 'REF' AS rule_id, (o_orderkey * 3)::VARCHAR AS id, (o_orderkey * 3)::VARCHAR AS value FROM orders WHERE o_orderkey * 3 NOT IN (SELECT o_orderkey FROM orders)")
def reference_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Order",), ("PLACED",))
    wanted = _read(spark, sf_dir, "orders").select(F.lit(UNIVERSE).alias("universe"), F.lit("Event").alias("key_label"), (F.col("o_orderkey") * 3).cast("string").alias("id"))
    return _only_ids(validate.check_references(wanted, g.nodes))


@query("SELECT 'Entity|Event|Order' AS labels, count(*) AS n, (SELECT string_agg(id, ',' ORDER BY id) FROM (SELECT o_orderkey::VARCHAR AS id FROM orders ORDER BY 1 LIMIT 5)) AS samples FROM orders")
def label_set_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Order", "Nation"), ("PLACED",))
    expected = spark.createDataFrame([("Entity|Location|Nation",)], "labels string")
    return introspect.label_set_findings(g, expected).select("labels", "n", F.array_join("samples", ",").alias("samples"))


_SHOP = validate.Ontology({k: frozenset(v) for k, v in ANCESTORS.items()})


def _shapes(spark: SparkSession, sf_dir: str, rules: list[shapes.Shape], leaves: tuple[str, ...], types: tuple[str, ...]) -> DataFrame:
    facts, subjects = shapes.project(graph(spark, sf_dir, leaves, types), _SHOP, inverse=shapes.inverse_paths(rules))
    return shapes.run_shapes(facts, subjects, rules).select("rule_id", "id", "property_name", "value")


@query(
    "SELECT 'P1' AS rule_id, p_partkey::VARCHAR AS id, 'size' AS property_name, p_size::VARCHAR AS value FROM part WHERE p_size NOT BETWEEN 3 AND 48 UNION ALL SELECT 'P1', p_partkey::VARCHAR, 'brand', p_brand FROM part WHERE p_brand = 'Brand#11' UNION ALL SELECT 'P2', c_custkey::VARCHAR, 'segment', c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE') UNION ALL SELECT 'P3', s_suppkey::VARCHAR, 'inNation', s_nationkey::VARCHAR FROM supplier"
)
def shape_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        shapes.Shape("P1", "values of a part", (shapes.Atom("size", 1, 1, "integer", 3, 48), shapes.Atom("brand", 1, 1, not_among=("Brand#11",)), shapes.Atom("price", 1, 1, "decimal", above=0)), ("Object",)),
        shapes.Shape("P2", "segment of the list", (shapes.Atom("segment", 1, 1, among=("BUILDING", "AUTOMOBILE")),), ("Customer",)),
        shapes.Shape("P3", "in one region", (shapes.Atom("inNation", 1, 1, cls="Region"),), ("Supplier",)),
    ]
    return _shapes(spark, sf_dir, rules, ("Part", "Customer", "Supplier", "Nation"), ("IN_NATION",))


@query(
    "SELECT 'C1' AS rule_id, o_orderkey::VARCHAR AS id, NULL::VARCHAR AS property_name, ((o_orderstatus = 'F')::INT + (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 100000)::INT)::VARCHAR AS value FROM orders WHERE ((o_orderstatus = 'F')::INT + (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 100000)::INT) <> 1 UNION ALL SELECT 'C2', n_nationkey::VARCHAR, '^inNation', count(s_suppkey)::VARCHAR || ' values' FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey HAVING count(s_suppkey) NOT BETWEEN 2 AND 5"
)
def shape_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = (shapes.Atom("status", 1, among=("F",)),)
    pressing = (shapes.Atom("priority", 1, among=("1-URGENT", "2-HIGH")), shapes.Atom("total", 1, above=100000))
    rules = [shapes.Shape("C1", "done or pressing, not both", (shapes.Choice((done, pressing), just_one=True),), ("Order",)), shapes.Shape("C2", "two to five suppliers", (shapes.Atom("^inNation", 2, 5),), ("Nation",))]
    g = graph(spark, sf_dir, ("Order", "Nation", "Supplier"), ("IN_NATION",))
    g = Graph(g.nodes, g.edges.where("src_label = 'Supplier'"))
    facts, subjects = shapes.project(g, _SHOP, inverse=["inNation"])
    return shapes.run_shapes(facts, subjects, rules).select("rule_id", "id", "property_name", "value")


@query(
    "WITH e AS (SELECT l_partkey p, l_suppkey s, count(*) n FROM lineitem GROUP BY 1, 2) SELECT 'E1' AS rule_id, p::VARCHAR AS id, 'count' AS property_name, n::VARCHAR AS value FROM e WHERE n > 1 UNION ALL SELECT 'T1', p_partkey::VARCHAR, 'size', p_size::DOUBLE || '/' || p_retailprice::DOUBLE FROM part WHERE p_size > p_retailprice - 900"
)
def shape_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [shapes.Shape("E1", "bought from a supplier once", (shapes.Atom("count", 1, 1, "integer", 1, 1),), predicate="suppliedBy", scope=("Part",)), shapes.Shape("T1", "size below price", (shapes.Together("size", "price"),), ("Part",))]
    g = graph(spark, sf_dir, ("Part",), ("SUPPLIED_BY",))
    cheap = F.struct(*[(F.col("props.price") - 900 if f == "price" else F.col(f"props.{f}")).alias(f) for f in struct_fields(g.nodes, "props")])
    facts, subjects = shapes.project(Graph(g.nodes.withColumn("props", cheap), g.edges), _SHOP)
    found = shapes.run_shapes(facts, subjects, rules).select("rule_id", "id", "property_name", "value")
    parts = _read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_retailprice").cast("string").alias("_price"))
    # the value as the table has it
    return found.join(parts, "id").select("rule_id", "id", "property_name", F.when(F.col("rule_id") == "T1", F.concat(F.split("value", "/")[0], F.lit("/"), F.col("_price"))).otherwise(F.col("value")).alias("value"))


# --- names and text --------------------------------------------------------


@query()
def slug_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slugs of the whole texts of all documents; no SQL, since strip_accents differs on compatibility forms."""
    return _read(spark, sf_dir, "documents").select("doc_id", naming.node_id(F.col("text")).alias("slug"))


@query("SELECT DISTINCT event_type, upper(event_type) || '_OF_USER' AS type FROM events")
def rel_type_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select("event_type", naming.relationship_type(F.concat("event_type", F.lit("OfUser"))).alias("type")).distinct()


@query("SELECT doc_id, substr(sha256(text), 1, 8) AS key FROM documents")
def sha_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", naming.text_key(F.col("text")).alias("key"))


@query("SELECT doc_id, md5(trim(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))) AS digest FROM documents")
def whitespace_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", F.md5(naming.normalize_space(F.col("text"))).alias("digest"))


@query("SELECT p_partkey, p_type, array_to_string(regexp_extract_all(p_type, '(ECONOMY|STANDARD|PROMO|SMALL|LARGE|MEDIUM|BRASS|TIN|STEEL)'), ',') AS codes, regexp_replace(p_type, '(ECONOMY|STANDARD|PROMO|SMALL|LARGE|MEDIUM|BRASS|TIN|STEEL)', '', 'g') AS rest FROM part")
def code_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = naming.game_codes(F.col("p_type"), ["ECONOMY", "STANDARD", "PROMO", "SMALL", "LARGE", "MEDIUM", "BRASS", "TIN", "STEEL"])
    return _read(spark, sf_dir, "part").select("p_partkey", "p_type", F.array_join(found["codes"], ",").alias("codes"), found["rest"].alias("rest"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey BETWEEN 1 AND 24 THEN ['I','II','III','IV','V','VI','VII','VIII','IX','X','XI','XII','XIII','XIV','XV','XVI','XVII','XVIII','XIX','XX','XXI','XXII','XXIII','XXIV'][n_nationkey] END AS numeral, CASE WHEN n_nationkey >= 1 THEN n_nationkey ELSE -1 END AS back FROM nation")
def roman_numerals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "nation").select("n_nationkey", naming.roman(F.col("n_nationkey")).alias("numeral"))
    return rows.withColumn("back", F.coalesce(naming.read_roman(F.col("numeral")), F.lit(-1)))


_MERGE_STEP = "list_reduce(list_prepend('', string_split(text, chr(10))), lambda acc, x: CASE WHEN length(string_split(acc, chr(1))[-1]) > 0 THEN acc || ' ' || x ELSE acc || x END || CASE WHEN length(CASE WHEN length(string_split(acc, chr(1))[-1]) > 0 THEN string_split(acc, chr(1))[-1] || ' ' || x ELSE x END) >= 100 THEN chr(1) ELSE '' END)"
_MERGE_SQL = f"""
WITH folded AS (SELECT doc_id, string_split({_MERGE_STEP}, chr(1)) AS parts FROM documents),
merged AS (SELECT doc_id, CASE WHEN parts[-1] = '' THEN parts[:-2] WHEN len(parts) = 1 THEN parts ELSE list_append(parts[:-3], parts[-2] || ' ' || parts[-1]) END AS m FROM folded)
SELECT doc_id, CASE WHEN m IS NULL THEN -1 ELSE len(m) END::INT AS chunks, md5(array_to_string(m, chr(10))) AS digest FROM merged
"""


@query(_MERGE_SQL)
def short_paragraph_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = wikitext.merge_short_column(F.split("text", "\n"))
    return _read(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.size(merged), F.lit(-1)).alias("chunks"), F.md5(F.array_join(merged, "\n")).alias("digest"))


@query("SELECT l_orderkey::VARCHAR AS subject, l_returnflag AS aspect, l_linestatus || l_quantity::INT AS text, CASE WHEN l_returnflag = 'R' THEN substr(sha256(l_linestatus || l_quantity::INT), 1, 8) ELSE (row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey))::VARCHAR END AS key FROM lineitem")
def chunk_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("subject"), F.col("l_returnflag").alias("aspect"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("seq"), F.concat("l_linestatus", F.col("l_quantity").cast("int").cast("string")).alias("text"))
    return sequence.number_chunks(lines, ["R"]).select("subject", "aspect", "text", "key")


@query("SELECT event_id, coalesce(CASE WHEN last_value(CASE WHEN event_type IN ('signup', 'error') THEN event_type END IGNORE NULLS) OVER w = 'signup' THEN last_value(CASE WHEN event_type IN ('signup', 'error') THEN event_id END IGNORE NULLS) OVER w END, -1) AS subject FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
def running_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sequence.running(_read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), F.col("event_type") == "error", "subject")
    return rows.select("event_id", F.coalesce("subject", F.lit(-1)).alias("subject"))


@query("WITH s AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey % 9 + 1 END AS first_gen, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderkey % 9 + 1 + o_orderkey % 4 END AS last_gen FROM orders), r AS (SELECT *, CASE WHEN first_gen IS NULL THEN 1 WHEN first_gen <= 9 AND coalesce(last_gen, 99) >= 9 THEN 2 ELSE 0 END AS rank, CASE WHEN first_gen IS NULL THEN 0 ELSE coalesce(last_gen, 99) END AS until FROM s) SELECT o_custkey, arg_max(o_orderkey, (rank, until, -o_orderkey)) AS picked FROM r GROUP BY o_custkey")
def span_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    gen = F.col("o_orderkey") % 9 + 1
    rows = _read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") != "P", gen).alias("first"), F.when((F.col("o_orderstatus") != "O") & (F.col("o_orderstatus") != "P"), gen + F.col("o_orderkey") % 4).alias("last"))
    return sequence.pick_span(rows, ["o_custkey"], "o_orderkey", 9).select("o_custkey", F.col("o_orderkey").alias("picked"))


@query("SELECT o_orderkey::VARCHAR AS id, o_custkey || ':' || o_orderstatus || ':' || row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS residue FROM orders")
def residue_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").alias("page"), F.col("o_orderstatus").alias("kind"), F.col("o_orderkey").alias("seq"))
    return sequence.residue_ids(rows).select("id", "residue")


@query("SELECT l_partkey, min(l_orderkey) AS first_seen, count(DISTINCT l_returnflag) AS flags FROM lineitem GROUP BY l_partkey")
def first_seen_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = compare.first_seen_merge(_read(spark, sf_dir, "lineitem"), ["l_partkey"], "l_orderkey", "l_returnflag")
    return merged.select("l_partkey", "first_seen", F.size("l_returnflag").cast("long").alias("flags"))


@query()
def fuzzy_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = graph(spark, sf_dir, ("Nation", "Region", "Supplier"), ("IN_REGION",)).nodes
    mentions = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("position"), F.expr("concat(left(n_name, 2), substr(n_name, 4))").alias("mention"), F.lit("Nation").alias("label"))
    return resolve.look_up(mentions, nodes)


@query("SELECT position, id, rank FROM (SELECT c_nationkey AS position, c_custkey::VARCHAR AS id, row_number() OVER (PARTITION BY c_nationkey ORDER BY (CASE WHEN c_mktsegment <> 'BUILDING' THEN 1 ELSE 0 END), c_acctbal DESC, length(c_name), c_custkey::VARCHAR) AS rank FROM customer) WHERE rank <= 15")
def rank_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("position"), F.lit("BUILDING").alias("label"), F.col("c_mktsegment").alias("key_label"), F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("score"))
    return resolve.rank_candidates(rows).select("position", "id", F.col("rank").cast("long").alias("rank"))


# --- comparisons and evaluation --------------------------------------------


@query("SELECT coalesce(a, b) AS key, CASE WHEN b IS NULL THEN 'customer' ELSE 'order' END AS side FROM (SELECT DISTINCT c_custkey * 2 AS a FROM customer) FULL JOIN (SELECT DISTINCT o_custkey AS b FROM orders) ON a = b WHERE a IS NULL OR b IS NULL")
def set_symmetric_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _read(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("key"))
    b = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"))
    return compare.symmetric_difference(a, b, ["key"], ("customer", "order"))


@query("WITH o AS (SELECT o_custkey AS key, max(o_orderkey) AS v FROM orders WHERE o_totalprice > 250000 GROUP BY 1), n AS (SELECT o_custkey AS key, max(o_orderkey) AS v FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1) SELECT key, coalesce(o.v, -1) AS old_version, coalesce(n.v, -1) AS new_version, CASE WHEN o.v IS NULL THEN 'added' WHEN n.v IS NULL THEN 'removed' ELSE 'changed' END AS change FROM o FULL JOIN n USING (key) WHERE o.v IS DISTINCT FROM n.v")
def pin_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest large order of each customer, pinned, against the latest open one."""
    orders = _read(spark, sf_dir, "orders")
    latest = lambda rows: rows.groupBy(F.col("o_custkey").alias("key")).agg(F.max("o_orderkey").alias("version"))
    return compare.pin_changes(latest(orders.where("o_totalprice > 250000")), latest(orders.where("o_orderstatus <> 'F'")), "key", "version").na.fill(-1, ["old_version", "new_version"])


@query("SELECT p_partkey AS key, 'size' AS field, p_size::VARCHAR AS first_value, (p_size + 1)::VARCHAR AS second_value FROM part WHERE p_size > 40 UNION ALL SELECT p_partkey, 'brand', p_brand, NULL FROM part WHERE p_size < 3")
def cross_check_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part")
    a = part.select(F.col("p_partkey").alias("key"), F.col("p_size").alias("size"), F.col("p_brand").alias("brand"))
    b = a.withColumn("brand", F.when(F.col("size") >= 3, F.col("brand"))).withColumn("size", F.when(F.col("size") > 40, F.col("size") + 1).otherwise(F.col("size")))
    return compare.cross_check(a, b, "key", ["size", "brand"])


@query(
    "WITH c AS (SELECT DISTINCT o_custkey AS q, o_orderkey AS n FROM orders WHERE o_orderstatus = 'F'), g AS (SELECT DISTINCT o_custkey AS q, o_orderkey AS n FROM orders WHERE o_totalprice > 250000), k AS (SELECT c_custkey AS question, (SELECT count(*) FROM c WHERE q = c_custkey) AS cited, (SELECT count(*) FROM g WHERE q = c_custkey) AS gold, (SELECT count(*) FROM c JOIN g USING (q, n) WHERE q = c_custkey) AS common FROM customer) SELECT question, cited, gold, common, round(CASE WHEN cited = 0 THEN CASE WHEN gold = 0 THEN 1.0 ELSE 0.0 END ELSE common / cited END, 6)::DOUBLE AS precision, round(CASE WHEN gold = 0 THEN 1.0 ELSE common / gold END, 6)::DOUBLE AS recall FROM k"
)
def precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders")
    rows = lambda df: df.select(F.col("o_custkey").alias("question"), F.col("o_orderkey").alias("node"))
    asked = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("question"))
    found = compare.precision_recall(rows(orders.where("o_orderstatus = 'F'")), rows(orders.where("o_totalprice > 250000")), asked)
    return found.withColumn("precision", F.round("precision", 6)).withColumn("recall", F.round("recall", 6))


@query("SELECT c_mktsegment, count(*) AS questions, count(*) FILTER (c_acctbal > 0) AS answers, round(coalesce(avg(c_acctbal) FILTER (c_acctbal > 0), 0), 4) AS precision, round(coalesce(avg(c_nationkey) FILTER (c_acctbal > 0), 0), 4) AS recall FROM customer GROUP BY 1")
def totals_by_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "customer").select("c_mktsegment", (F.col("c_acctbal") > 0).alias("answered"), F.col("c_acctbal").alias("precision"), F.col("c_nationkey").alias("recall"))
    return compare.totals(rows, "c_mktsegment").withColumn("precision", F.round("precision", 4)).withColumn("recall", F.round("recall", 4))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS large, count(*) FILTER (value IS NULL) AS none FROM events GROUP BY 1")
def conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.count_cases(_read(spark, sf_dir, "events"), ["event_type"], {"large": F.col("value") > 50, "none": F.col("value").isNull()})


@query("SELECT least(count(*), 5000) AS shown, count(*) > 5000 AS truncated FROM orders")
def fetch_cap_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, more = compare.truncated(_read(spark, sf_dir, "orders").select("o_orderkey"), 5000)
    return rows.agg(F.count("*").alias("shown")).withColumn("truncated", F.lit(more))


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def windowed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_counts(_read(spark, sf_dir, "events")).select(F.date_format("start", "yyyy-MM-dd HH").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("SELECT count(*) AS nodes, sum(n)::BIGINT AS stubs FROM (SELECT n_nationkey, 1 AS n FROM nation UNION ALL SELECT c_custkey, 0 FROM customer)")
def stub_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Nation", "Customer"), ("IN_NATION",))
    return g.nodes.agg(F.count("*").alias("nodes"), F.count_if(is_stub(g.nodes)).alias("stubs"))


@query("WITH e AS (SELECT l_partkey, l_suppkey, count(*) n FROM lineitem GROUP BY 1, 2), c AS (SELECT l_orderkey, l_partkey FROM lineitem GROUP BY 1, 2) SELECT 'SUPPLIED_BY' AS type, 'count' AS property, 'bigint' AS kind, count(*) AS n, true AS mandatory FROM e UNION ALL SELECT 'CONTAINS', unnest(['quantity', 'price', 'count']), unnest(['double', 'double', 'bigint']), (SELECT count(*) FROM c), true")
def relationship_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.relationship_shapes(graph(spark, sf_dir, ("Part",), ("SUPPLIED_BY", "CONTAINS", "PLACED")))


@query(
    "SELECT 'leaf' AS part, 'Nation' AS name, '' AS detail, count(*) AS n FROM nation UNION ALL SELECT 'leaf', 'Customer', '', count(*) FROM customer UNION ALL SELECT 'property', 'Customer.acctbal', CASE WHEN count(c_acctbal) = count(*) THEN 'double' ELSE 'double?' END, count(c_acctbal) FROM customer UNION ALL SELECT 'property', 'Customer.segment', (CASE WHEN count(c_mktsegment) = count(*) THEN 'string ' ELSE 'string? ' END) || string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment), count(c_mktsegment) FROM customer UNION ALL SELECT 'type', 'IN_NATION', '', count(*) FROM customer UNION ALL SELECT 'pattern', 'Customer-IN_NATION->Nation', '', count(*) FROM customer"
)
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.schema(graph(spark, sf_dir, ("Nation", "Customer"), ("IN_NATION",)), ANCESTORS)


@query(
    "SELECT 'label set' AS \"check\", 'Agent|Entity|Supplier' AS subject, count(*) AS n, true AS failing FROM supplier UNION ALL SELECT 'edge typing', 'IN_NATION', count(*), true FROM supplier UNION ALL SELECT 'missing', 'Customer', count(DISTINCT o_custkey), true FROM orders WHERE o_custkey + 100 NOT IN (SELECT c_custkey FROM customer) HAVING count(*) > 0 UNION ALL SELECT 'stub', 'Nation', count(*), false FROM nation UNION ALL SELECT 'orphan stub', 'Nation', count(*), false FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier UNION SELECT c_nationkey FROM customer) HAVING count(*) > 0"
)
def sweep_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = graph(spark, sf_dir, ("Nation", "Supplier", "Customer"), ("IN_NATION",))
    expected = spark.createDataFrame([("Entity|Location|Nation",), ("Agent|Customer|Entity",)], "labels string")
    domains = spark.createDataFrame([("IN_NATION", ["Customer"], ["Location"])], "type string, start_labels array<string>, end_labels array<string>")
    wanted = _read(spark, sf_dir, "orders").select(F.lit(UNIVERSE).alias("universe"), F.lit("Customer").alias("key_label"), (F.col("o_custkey") + 100).cast("string").alias("id")).distinct()
    return introspect.sweep(g, expected, domains, wanted)


def _order_batch(spark: SparkSession, sf_dir: str) -> tuple[Graph, runner.Batch]:
    """The graph of customers and their orders, and a batch of the customers with their finished orders, each claiming all it placed."""
    g = graph(spark, sf_dir, ("Customer", "Order"), ("PLACED",))
    done = _read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("dst_id"))
    edges = g.edges.join(done, "dst_id", "left_semi").select(*g.edges.columns)
    customers = g.nodes.where("key_label = 'Customer'")
    none = F.lit(None)
    stubs = g.nodes.where("key_label = 'Order'").join(done.withColumnRenamed("dst_id", "id"), "id", "left_semi").select(*g.nodes.columns)
    stubs = stubs.withColumn("props", F.struct(*[none.cast(f.dataType).alias(f.name) for f in g.nodes.schema["props"].dataType.fields]))
    claims = customers.select("universe", F.lit("Customer").alias("anchor_label"), F.col("id").alias("anchor_id"), F.lit("PLACED").alias("type"), F.lit("out").alias("direction"), F.lit("Order").alias("other_label"), F.lit(True).alias("owns_other_end"))
    return g, runner.batch(customers, edges, stubs, claims)


@query("SELECT 0::BIGINT AS nodes_created, count(*) FILTER (o_orderstatus <> 'F') AS nodes_deleted, (SELECT count(*) FROM customer) + count(*) FILTER (o_orderstatus = 'F') AS nodes_kept, 0::BIGINT AS edges_created, count(*) FILTER (o_orderstatus <> 'F') AS edges_deleted, count(*) FILTER (o_orderstatus = 'F') AS edges_kept FROM orders")
def write_batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, b = _order_batch(spark, sf_dir)
    return runner.write_batch(g, b, UNIVERSE, list(ANCESTORS))[1]


@query("SELECT o_custkey::VARCHAR AS anchor_id, count(*) AS kept FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def claim_rows_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, kept = runner.claim_rows(_order_batch(spark, sf_dir)[1], "out")
    return kept.groupBy("anchor_id").agg(F.count("*").alias("kept"))


@query("SELECT 'BN' AS rule_id, o_custkey::VARCHAR AS id, count(*)::VARCHAR AS value FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey HAVING count(*) > 1 UNION ALL SELECT 'BX', o_custkey::VARCHAR, 'Order/' || o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def batch_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers taken as nodes once for each open order, with an edge to an order that the batch lacks."""
    g = graph(spark, sf_dir, ("Customer",), ("PLACED",))
    open_ = _read(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    rows = open_.select(F.col("o_custkey").cast("string").alias("id")).join(g.nodes, "id").select(*g.nodes.columns)
    edges = g.edges.join(open_.select(F.col("o_orderkey").cast("string").alias("dst_id")), "dst_id", "left_semi").select(*g.edges.columns)
    return _only_ids(runner.check_batch(runner.batch(rows, edges)))


@query("WITH n AS (SELECT n_nationkey AS id, 'Nation' AS label FROM nation UNION ALL SELECT r_regionkey, 'Region' FROM region), l AS (SELECT id, 'Location' AS label FROM n UNION ALL SELECT id, label FROM n) SELECT 'UQ' AS rule_id, id::VARCHAR AS id, label AS class_label, count(*)::VARCHAR AS value FROM l GROUP BY id, label HAVING count(*) > 1")
def id_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runner.unique_ids(graph(spark, sf_dir, ("Nation", "Region"), ("IN_REGION",)).nodes, ["Location", "Nation", "Region"])
    return found.select("rule_id", "id", "class_label", "value")


@query("SELECT r_name AS name, count(n_nationkey) AS nations FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY 1")
def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A graph written as a snapshot, then one without edges over it; the first, read back by its version."""
    with_edges = graph(spark, sf_dir, ("Nation", "Region"), ("IN_REGION",))
    root = f"{tables.scratch(spark)}/snapshots-{uuid.uuid4().hex}"
    version = tables.commit_graph(spark, with_edges, root)
    tables.commit_graph(spark, Graph(with_edges.nodes, with_edges.edges.limit(0)), root)
    g, now = tables.read_graph(spark, root, version), tables.read_graph(spark, root)
    regions = pattern.expand(Graph(g.nodes, g.edges), pattern.scan(g, "r", "Region"), "r", "IN_REGION", "n", direction="in", optional=True)
    regions = pattern.without(now, regions, "r", "IN_REGION", direction="in")
    return regions.groupBy(F.col("r.name").alias("name")).agg(F.count("n.id").alias("nations"))


@query("SELECT p_partkey::VARCHAR AS name, s_suppkey::VARCHAR AS code, CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN (p_partkey, s_suppkey) IN (SELECT (l_partkey, l_suppkey) FROM lineitem) THEN p_partkey || '-' || s_suppkey ELSE p_partkey::VARCHAR END AS id, p_partkey % 10 <> 0 AND (p_partkey, s_suppkey) NOT IN (SELECT (l_partkey, l_suppkey) FROM lineitem) AS fallback FROM part JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier)")
def form_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the supplier that their number names: the pair if it was ever bought, else the part; every tenth part has no name."""
    parts, suppliers = _read(spark, sf_dir, "part"), _read(spark, sf_dir, "supplier")
    n = suppliers.count()
    refs = parts.select(F.col("p_partkey").cast("string").alias("name"), (F.col("p_partkey") % n).alias("s_suppkey")).join(suppliers, "s_suppkey").select("name", F.col("s_suppkey").cast("string").alias("code"))
    names = parts.where("p_partkey % 10 <> 0").select(F.col("p_partkey").cast("string").alias("name"), F.col("p_partkey").cast("string").alias("base"))
    forms = _read(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_partkey", "l_suppkey").alias("id"))
    return reference.resolve_forms(refs, names, forms)


@query("SELECT o_custkey AS key, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1")
def unowned_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = _read(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("key"))
    return reference.unowned(_read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")), owners, ["key"])


@query("SELECT 'event_type' AS dimension, coalesce(event_type, 'none') AS value, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'large', coalesce(CASE WHEN value > 50 THEN 'yes' END, 'none'), count(*) FROM events GROUP BY 2")
def dimension_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.case_counts(_read(spark, sf_dir, "events").withColumn("large", F.when(F.col("value") > 50, "yes")), ["event_type", "large"])


@query("WITH t AS (SELECT n_name AS title, r_name AS target FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0), c AS (SELECT n_name AS title FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT 'X' || s_name FROM supplier), to_ AS (SELECT c.title, coalesce(t.target, c.title) AS target FROM c LEFT JOIN t USING (title)) SELECT title, CASE WHEN target = 'ASIA' THEN 'not_a_location' WHEN target IN (SELECT r_name FROM region) THEN 'location' WHEN target IN (SELECT n_name FROM nation) THEN 'not_a_location' ELSE 'unknown_location' END AS verdict, regexp_replace(replace(CASE WHEN target = 'ASIA' OR target IN (SELECT n_name FROM nation) THEN title ELSE target END, '_', ' '), '#.*$', '') AS page FROM to_")
def location_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as locations but for a foreign one, every second nation as a redirect to its region, other nations as other pages, suppliers unknown."""
    nations = _read(spark, sf_dir, "nation").join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    text = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("#REDIRECT [["), F.col("r_name"), F.lit("]]"))).otherwise("a nation")
    regions = _read(spark, sf_dir, "region").select(F.col("r_name").alias("title"))
    pages = nations.select(F.col("n_name").alias("title"), text.alias("wikitext")).unionByName(regions.withColumn("wikitext", F.lit("{{Place}} a region")))
    index = reference.location_index(pages, regions.where("title = 'ASIA'"), ["place"])
    candidates = pages.select("title").union(_read(spark, sf_dir, "supplier").select(F.concat(F.lit("X"), F.col("s_name"))))
    return reference.classify_locations(candidates, index)
