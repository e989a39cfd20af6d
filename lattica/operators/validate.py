"""The gate before a write, and shape rules: each check gives rows of violations.

violations: rule_id, class_label, id, property_name, value, message
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VIOLATION = "rule_id string, class_label string, id string, property_name string, value string, message string"


def violations(rows: DataFrame, rule: str, property_: str | None, value: Column, message: str) -> DataFrame:
    """Rows with key_label and id as violations of a rule."""
    return rows.select(F.lit(rule).alias("rule_id"), F.col("key_label").alias("class_label"), "id", F.lit(property_).cast("string").alias("property_name"), value.cast("string").alias("value"), F.lit(message).alias("message"))


@dataclass(frozen=True)
class Ontology:
    """Classes with their strict ancestors, and properties with domains and ranges (empty: anything)."""

    ancestors: Mapping[str, frozenset[str]]
    domains: Mapping[str, frozenset[str]] = field(default_factory=dict)
    ranges: Mapping[str, frozenset[str]] = field(default_factory=dict)
    datatypes: Mapping[str, str] = field(default_factory=dict)

    def closure(self, spark: SparkSession) -> DataFrame:
        """(class, label) of each class with itself and all its ancestors."""
        return spark.createDataFrame([(c, a) for c, above in sorted(self.ancestors.items()) for a in sorted({c, *above})], "class string, label string")

    def table(self, spark: SparkSession, of: Mapping[str, frozenset[str]]) -> DataFrame:
        return spark.createDataFrame([(p, c) for p, classes in sorted(of.items()) for c in sorted(classes)], "property string, allowed string")


def transitive_ancestors(parents: Mapping[str, Sequence[str]]) -> dict[str, frozenset[str]]:
    """Strict ancestors of every class; cycles end."""
    out = {}
    for name in {*parents, *(p for ps in parents.values() for p in ps)}:
        seen: set[str] = set()
        todo = list(parents.get(name, ()))
        while todo:
            at = todo.pop()
            if at not in seen and at != name:
                seen.add(at)
                todo.extend(parents.get(at, ()))
        out[name] = frozenset(seen)
    return out


def key_class(name: str, ancestors: Mapping[str, frozenset[str]], keys: frozenset[str]) -> str:
    """The nearest class, the deepest of itself and its ancestors, that is a key class; itself if none is."""
    found = [c for c in {name, *ancestors.get(name, ())} if c in keys]
    return max(found, key=lambda c: (len(ancestors.get(c, ())), c)) if found else name


def check_terms(nodes: DataFrame, edges: DataFrame, ontology: Ontology) -> DataFrame:
    """IRI: classes and properties that the ontology doesn't declare."""
    spark = nodes.sparkSession
    classes = spark.createDataFrame([(c,) for c in ontology.ancestors], "key_label string")
    properties = spark.createDataFrame([(p,) for p in {*ontology.domains, *ontology.ranges}], "type string")
    odd_nodes = violations(nodes.join(F.broadcast(classes), "key_label", "left_anti"), "IRI", None, F.col("key_label"), "class is not declared")
    odd_edges = edges.join(F.broadcast(properties), "type", "left_anti").select(F.col("src_label").alias("key_label"), F.col("src_id").alias("id"), "type")
    return odd_nodes.unionByName(violations(odd_edges, "IRI", "type", F.col("type"), "property is not declared"))


def check_ids(nodes: DataFrame, ontology: Ontology) -> DataFrame:
    """ID: several nodes of one id whose classes share a key or descend from one another.

    Counted per id and label of the closure, so no pairs are made.
    """
    spark = nodes.sparkSession
    labels = nodes.select("universe", "id", "key_label").distinct().join(F.broadcast(ontology.closure(spark)), F.col("key_label") == F.col("class"))
    own = labels.where("label = key_label").select("universe", "id", F.col("key_label").alias("above"))
    below = labels.where("label <> key_label").join(own, ["universe", "id"]).where("label = above").select("universe", "id", "key_label").distinct()
    same = nodes.groupBy("universe", "id", "key_label").agg(F.count("*").alias("_n")).where("_n > 1").select("universe", "id", "key_label")
    return violations(below.union(same).distinct(), "ID", "id", F.col("id"), "several nodes share one identity")


def check_edge_typing(nodes: DataFrame, edges: DataFrame, ontology: Ontology) -> DataFrame:
    """T1: ends whose class, with its ancestors, is outside the property's domain or range."""
    spark = nodes.sparkSession
    closure = F.broadcast(ontology.closure(spark))
    out = []
    for side, of in (("src", ontology.domains), ("dst", ontology.ranges)):
        limited = {p: c for p, c in of.items() if c}
        if not limited:
            continue
        allowed = F.broadcast(ontology.table(spark, limited))
        typed = edges.join(allowed.select("property").distinct(), F.col("type") == F.col("property"), "left_semi")
        fits = closure.join(allowed, F.col("label") == F.col("allowed")).select(F.col("property").alias("type"), F.col("class").alias(f"{side}_label")).distinct()
        bad = typed.join(F.broadcast(fits), ["type", f"{side}_label"], "left_anti")
        out.append(violations(bad.select(F.col(f"{side}_label").alias("key_label"), F.col(f"{side}_id").alias("id"), "type"), "T1", "type", F.col("type"), "start is outside the domain" if side == "src" else "end is outside the range"))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], VIOLATION)


def check_references(stubs: DataFrame, nodes: DataFrame) -> DataFrame:
    """REF: stubs that no node of the graph answers to."""
    n, o = stubs.alias("n"), nodes.alias("o")
    lost = n.join(o, (F.col("n.universe") == F.col("o.universe")) & (F.col("n.id") == F.col("o.id")) & F.array_contains(F.col("o.labels"), F.col("n.key_label")), "left_anti")
    return violations(lost, "REF", "id", F.col("id"), "reference is not in the graph")


def check_seed(stubs: DataFrame, seed: DataFrame) -> DataFrame:
    """ABOX: stubs of classes that the seed lists fully, but without that individual."""
    of_class = stubs.join(F.broadcast(seed.select("key_label").distinct()), "key_label", "left_semi")
    return violations(of_class.join(seed, ["key_label", "id"], "left_anti"), "ABOX", "id", F.col("id"), "individual is not in the seed")


def gate(nodes: DataFrame, edges: DataFrame, stubs: DataFrame, ontology: Ontology, seed: DataFrame, graph_nodes: DataFrame | None) -> DataFrame:
    """All checks in order; undeclared terms stop the others."""
    terms = check_terms(nodes.select("universe", "key_label", "id").unionByName(stubs.select("universe", "key_label", "id")), edges, ontology)
    if not terms.isEmpty():
        return terms
    found = [terms, check_ids(nodes, ontology), check_edge_typing(nodes, edges, ontology), check_seed(stubs, seed)]
    if graph_nodes is not None:
        found.append(check_references(stubs, graph_nodes))
    return reduce(DataFrame.unionByName, found)


# --- shape rules -----------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A rule over nodes of a class; ``check`` is true for a node that breaks it."""

    rule_id: str
    label: str
    property: str | None
    check: Column
    message: str


def in_range(column: str, low: float | None = None, high: float | None = None, required: bool = False) -> Column:
    """Breaks a range, or is missing though required."""
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return c.isNull() if low is None and high is None and required else F.coalesce(bad, F.lit(required))


def one_of(column: str, values: Sequence[str], required: bool = False) -> Column:
    return F.coalesce(~F.col(column).isin(list(values)), F.lit(required))


def matches(column: str, pattern: str) -> Column:
    return F.coalesce(~F.col(column).rlike(pattern), F.lit(True))


def both_or_neither(a: str, b: str) -> Column:
    return F.col(a).isNull() != F.col(b).isNull()


def ordered(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) > F.col(b), F.lit(False))


def exactly_one(*columns: str) -> Column:
    """Breaks unless just one of the columns has a value."""
    return reduce(lambda x, y: x + y, [F.col(c).isNotNull().cast("int") for c in columns]) != 1


def run_rules(nodes: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations of all rules in one scan of the nodes."""
    found = F.array(*[F.when(F.array_contains("labels", r.label) & r.check, F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.property).cast("string").alias("property_name"), (F.col(r.property).cast("string") if r.property else F.lit(None).cast("string")).alias("value"), F.lit(r.message).alias("message"))) for r in rules])
    rows = nodes.select(F.col("key_label").alias("class_label"), "id", F.explode(F.filter(found, lambda v: v.isNotNull())).alias("_v"))
    return rows.select("_v.rule_id", "class_label", "id", "_v.property_name", "_v.value", "_v.message")


def edge_count_rule(nodes: DataFrame, edges: DataFrame, rule: str, label: str, type_: str, least: int, most: int | None, *, incoming: bool = False, other: str | None = None) -> DataFrame:
    """Nodes of a class with too few or too many edges of a type, out of or into them, optionally to one class."""
    near, far = ("dst", "src") if incoming else ("src", "dst")
    used = edges.where(F.col("type") == type_)
    if other:
        used = used.where(F.col(f"{far}_label") == other)
    counts = used.groupBy("universe", F.col(f"{near}_label").alias("key_label"), F.col(f"{near}_id").alias("id")).agg(F.count("*").alias("_n"))
    rows = nodes.where(F.array_contains("labels", label)).join(counts, ["universe", "key_label", "id"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    bad = F.col("_n") < least if most is None else (F.col("_n") < least) | (F.col("_n") > most)
    return violations(rows.where(bad), rule, type_, F.col("_n"), f"{least} to {'any' if most is None else most} edges expected")


def pair_types_rule(edges: DataFrame, rule: str, types: Sequence[str], most: int = 1) -> DataFrame:
    """Ordered pairs joined by more than ``most`` of some types."""
    pairs = edges.where(F.col("type").isin(list(types))).groupBy("src_label", "src_id", "dst_id").agg(F.count_distinct("type").alias("_n")).where(F.col("_n") > most)
    return violations(pairs.select(F.col("src_label").alias("key_label"), F.col("src_id").alias("id"), "_n", "dst_id"), rule, "type", F.col("dst_id"), f"at most {most} of these types a pair")


def paired_edges_rule(nodes: DataFrame, edges: DataFrame, rule: str, label: str, first: str, second: str, forbidden: str | None = None) -> DataFrame:
    """Two edge types both or neither, with different ends, and neither to a forbidden id."""
    of = edges.where(F.col("type").isin(first, second)).groupBy("universe", F.col("src_label").alias("key_label"), F.col("src_id").alias("id"))
    ends = of.agg(F.max(F.when(F.col("type") == first, F.col("dst_id"))).alias("_a"), F.max(F.when(F.col("type") == second, F.col("dst_id"))).alias("_b"))
    rows = nodes.where(F.array_contains("labels", label)).join(ends, ["universe", "key_label", "id"])
    bad = (F.col("_a").isNull() != F.col("_b").isNull()) | F.coalesce(F.col("_a") == F.col("_b"), F.lit(False))
    if forbidden:
        bad = bad | F.coalesce(F.col("_a") == forbidden, F.lit(False)) | F.coalesce(F.col("_b") == forbidden, F.lit(False))
    return violations(rows.where(bad), rule, first, F.concat_ws("/", "_a", "_b"), "both or neither, and different")


def edge_role_rule(edges: DataFrame, nodes: DataFrame, rule: str, type_: str, role: str, allowed: Mapping[str, str]) -> DataFrame:
    """Edges whose role property doesn't fit the class of their end."""
    table = F.create_map(*[F.lit(x) for pair in allowed.items() for x in pair])
    ends = nodes.select("universe", F.col("key_label").alias("dst_label"), F.col("id").alias("dst_id"), F.col("labels").alias("_l"))
    rows = edges.where(F.col("type") == type_).join(ends, ["universe", "dst_label", "dst_id"])
    wanted = F.element_at(table, F.col(f"props.{role}"))
    bad = rows.where(wanted.isNull() | ~F.array_contains("_l", wanted))
    return violations(bad.select(F.col("src_label").alias("key_label"), F.col("src_id").alias("id"), F.col(f"props.{role}").alias("_r")), rule, role, F.col("_r"), "role does not fit the end's class")
