"""What the graph holds: censuses, leaf labels, property shapes, enums, patterns, sweeps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.operators.graph import NODE_KEY, Graph, is_stub, struct_fields

MAX_ENUM = 30
SAMPLES = 5


def count_labels(graph: Graph) -> DataFrame:
    """Nodes by label. Label sets are counted first, so only the few sets are exploded."""
    sets = graph.nodes.groupBy("labels").agg(F.count("*").alias("n"))
    return sets.select(F.explode("labels").alias("label"), "n").groupBy("label").agg(F.sum("n").alias("n"))


def leaf_label(labels: Column, ancestors: Mapping[str, Sequence[str]]) -> Column:
    """The one label of a set that no other of the set descends from; null unless there is just one."""
    table = F.create_map(*[x for k, v in ancestors.items() for x in (F.lit(k), F.array(*map(F.lit, v)) if v else F.array().cast("array<string>"))])
    known = F.filter(labels, lambda l: F.array_contains(F.map_keys(table), l))
    above = F.flatten(F.transform(known, lambda l: F.element_at(table, l)))
    leaves = F.array_except(known, above)
    return F.when(F.size(leaves) == 1, F.element_at(leaves, 1))


def count_leaves(graph: Graph, ancestors: Mapping[str, Sequence[str]]) -> DataFrame:
    sets = graph.nodes.groupBy(F.array_sort("labels").alias("labels")).agg(F.count("*").alias("n"))
    return sets.select(leaf_label(F.col("labels"), ancestors).alias("leaf"), "n").groupBy("leaf").agg(F.sum("n").alias("n"))


def count_types(graph: Graph) -> DataFrame:
    """Edges by type whose start exists; the end may lie elsewhere."""
    starts = graph.nodes.select("universe", F.col("key_label").alias("src_label"), F.col("id").alias("src_id"))
    return graph.edges.join(starts, ["universe", "src_label", "src_id"], "left_semi").groupBy("type").agg(F.count("*").alias("n"))


def count_patterns(graph: Graph) -> DataFrame:
    """(start leaf, type, end leaf) with counts, both ends existing."""
    src = graph.nodes.select("universe", F.col("key_label").alias("src_label"), F.col("id").alias("src_id"), F.col("leaf").alias("start_leaf"))
    dst = graph.nodes.select("universe", F.col("key_label").alias("dst_label"), F.col("id").alias("dst_id"), F.col("leaf").alias("end_leaf"))
    both = graph.edges.join(src, ["universe", "src_label", "src_id"]).join(dst, ["universe", "dst_label", "dst_id"])
    return both.groupBy("start_leaf", "type", "end_leaf").agg(F.count("*").alias("n"))


def _unpivoted(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    fields = rows.schema["props"].dataType.fields
    pairs = F.array(*[F.struct(F.lit(f.name).alias("property"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"props.{f.name}").cast("string").alias("value")) for f in fields])
    return rows.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.property", "_p.type", "_p.value")


def property_shapes(graph: Graph) -> DataFrame:
    """(leaf, property, type, n, mandatory): mandatory if every label set of the leaf has it on every node.

    One pass: counts per label set and property, without unpivoting rows.
    """
    fields = graph.nodes.schema["props"].dataType.fields
    sets = graph.nodes.groupBy("leaf", F.array_sort("labels").alias("_set")).agg(F.count("*").alias("_all"), *[F.count(f"props.{f.name}").alias(f"_n_{f.name}") for f in fields])
    pairs = F.array(*[F.struct(F.lit(f.name).alias("property"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"_n_{f.name}").alias("n")) for f in fields])
    long = sets.select("leaf", "_all", F.explode(pairs).alias("_p")).select("leaf", "_all", "_p.*")
    return long.groupBy("leaf", "property", "type").agg(F.sum("n").alias("n"), F.bool_and(F.col("n") == F.col("_all")).alias("mandatory")).where("n > 0")


def enum_values(graph: Graph, most: int = MAX_ENUM) -> DataFrame:
    """(leaf, property, value) of text properties with at most ``most`` values; counted by partial aggregation, values never gathered in one place."""
    values = _unpivoted(graph.nodes, ["leaf"]).where("type = 'string' and value is not null").select("leaf", "property", "value").distinct()
    few = values.groupBy("leaf", "property").agg(F.count("*").alias("_n")).where(F.col("_n") <= most)
    return values.join(few.drop("_n"), ["leaf", "property"])


def edge_typing_faults(graph: Graph, domains: DataFrame) -> DataFrame:
    """Per type the edges whose ends have none of the allowed labels: start_faults, end_faults, and the first sample ids.

    domains: type, start_labels, end_labels (arrays; empty: anything goes).
    """
    src = graph.nodes.select("universe", F.col("key_label").alias("src_label"), F.col("id").alias("src_id"), F.col("labels").alias("_sl"))
    dst = graph.nodes.select("universe", F.col("key_label").alias("dst_label"), F.col("id").alias("dst_id"), F.col("labels").alias("_dl"))
    rows = graph.edges.join(src, ["universe", "src_label", "src_id"]).join(dst, ["universe", "dst_label", "dst_id"]).join(domains, "type")
    bad = lambda ends, allowed: (F.size(allowed) > 0) & ~F.arrays_overlap(ends, allowed)
    start, end = bad("_sl", "start_labels"), bad("_dl", "end_labels")
    return rows.groupBy("type").agg(F.count_if(start).alias("start_faults"), F.count_if(end).alias("end_faults"), F.min(F.when(start, F.col("src_id"))).alias("start_sample"), F.min(F.when(end, F.col("dst_id"))).alias("end_sample"))


def label_set_findings(graph: Graph, expected: DataFrame) -> DataFrame:
    """Label sets that no class has: (labels, n, samples). expected: labels, sorted and joined by |."""
    joined = graph.nodes.select(F.array_join(F.array_sort("labels"), "|").alias("labels"), "id")
    odd = joined.join(expected, "labels", "left_anti")
    first = odd.withColumn("_nth", F.row_number().over(Window.partitionBy("labels").orderBy("id"))).where(F.col("_nth") <= SAMPLES)
    samples = first.groupBy("labels").agg(F.array_sort(F.collect_list("id")).alias("samples"))
    return odd.groupBy("labels").agg(F.count("*").alias("n")).join(samples, "labels")


def missing_nodes(graph: Graph, wanted: DataFrame) -> DataFrame:
    """Keys (universe, key_label, id) that no node has."""
    n, o = wanted.alias("n"), graph.nodes.alias("o")
    return n.join(o, (F.col("n.universe") == F.col("o.universe")) & (F.col("n.id") == F.col("o.id")) & F.array_contains(F.col("o.labels"), F.col("n.key_label")), "left_anti")


def stubs(graph: Graph, without_keys: DataFrame | None = None) -> DataFrame:
    """Nodes with id and name only, but for given keys."""
    rows = graph.nodes.where(is_stub(graph.nodes)).select(*NODE_KEY)
    return rows if without_keys is None else rows.join(without_keys, NODE_KEY, "left_anti")


def orphans(graph: Graph) -> DataFrame:
    """Nodes without any edge."""
    ends = graph.edges.select("universe", F.col("src_label").alias("key_label"), F.col("src_id").alias("id")).union(graph.edges.select("universe", "dst_label", "dst_id"))
    return graph.nodes.join(ends, NODE_KEY, "left_anti").select(*NODE_KEY)


def schema_text(graph: Graph) -> DataFrame:
    """One line of text per leaf: its count and properties, optional ones marked."""
    shapes = property_shapes(graph)
    text = F.concat("property", F.when(F.col("mandatory"), "").otherwise("?"), F.lit(": "), "type")
    lines = shapes.groupBy("leaf").agg(F.array_join(F.array_sort(F.collect_list(text)), ", ").alias("properties"))
    counts = graph.nodes.groupBy("leaf").agg(F.count("*").alias("n"))
    return counts.join(lines, "leaf", "left").select("leaf", F.concat("leaf", F.lit(" ("), F.format_number("n", 0), F.lit("): "), F.coalesce("properties", F.lit(""))).alias("line"))


def fingerprint(graph: Graph) -> DataFrame:
    """One row: a hash of all label and type counts, whatever their order."""
    labels = count_labels(graph).select(F.concat_ws("=", F.lit("label"), "label", "n").alias("x"))
    types = count_types(graph).select(F.concat_ws("=", F.lit("type"), "type", "n").alias("x"))
    return labels.union(types).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("x")), ";"), 256).alias("fingerprint"))


def property_names(graph: Graph) -> list[str]:
    """id and name first, then by name."""
    return ["id", "name", *sorted(struct_fields(graph.nodes, "props"))]


def relationship_shapes(graph: Graph) -> DataFrame:
    """(type, property, kind, n, mandatory) of edge properties: mandatory if every edge of the type has it."""
    fields = graph.edges.schema["props"].dataType.fields
    counts = graph.edges.groupBy("type").agg(F.count("*").alias("_all"), *[F.count(f"props.{f.name}").alias(f"_n_{f.name}") for f in fields])
    pairs = F.array(*[F.struct(F.lit(f.name).alias("property"), F.lit(f.dataType.simpleString()).alias("kind"), F.col(f"_n_{f.name}").alias("n")) for f in fields])
    return counts.select("type", "_all", F.explode(pairs).alias("_p")).select("type", "_p.*", (F.col("_p.n") == F.col("_all")).alias("mandatory")).where("n > 0")


def relationship_enums(graph: Graph, most: int = MAX_ENUM) -> DataFrame:
    """(type, property, value) of text properties of edges with at most ``most`` values."""
    texts = [f.name for f in graph.edges.schema["props"].dataType.fields if f.dataType.simpleString() == "string"]
    if not texts:
        return graph.edges.select("type", F.lit("").alias("property"), F.lit("").alias("value")).limit(0)
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("property"), F.col(f"props.{f}").alias("value")) for f in texts])).alias("_p")
    values = graph.edges.select("type", pairs).select("type", "_p.*").where("value is not null").distinct()
    return values.join(values.groupBy("type", "property").agg(F.count("*").alias("_n")).where(F.col("_n") <= most).drop("_n"), ["type", "property"])


def plain_type(raw: Column) -> Column:
    """A property's type without what says that it is required."""
    return F.trim(F.regexp_replace(raw, r"\s+NOT NULL\b", ""))


def schema(graph: Graph, ancestors: Mapping[str, Sequence[str]]) -> DataFrame:
    """The whole schema in rows (part, name, detail, n), sorted: leaves, their properties with enums, edge types, their properties, patterns."""
    values = enum_values(graph).groupBy("leaf", "property").agg(F.array_join(F.array_sort(F.collect_set("value")), "|").alias("values"))  # MAX_ENUM values each
    shapes = property_shapes(graph).join(values, ["leaf", "property"], "left")
    detail = F.concat(plain_type(F.col("type")), F.when(F.col("mandatory"), "").otherwise("?"), F.coalesce(F.concat(F.lit(" "), F.col("values")), F.lit("")))
    edge_detail = F.concat("kind", F.when(F.col("mandatory"), "").otherwise("?"))
    parts = [
        count_leaves(graph, ancestors).select(F.lit("leaf").alias("part"), F.col("leaf").alias("name"), F.lit("").alias("detail"), "n"),
        shapes.select(F.lit("property"), F.concat_ws(".", "leaf", "property"), detail, "n"),
        count_types(graph).select(F.lit("type"), "type", F.lit(""), "n"),
        relationship_shapes(graph).select(F.lit("type property"), F.concat_ws(".", "type", "property"), edge_detail, "n"),
        count_patterns(graph).select(F.lit("pattern"), F.concat(F.col("start_leaf"), F.lit("-"), F.col("type"), F.lit("->"), F.col("end_leaf")), F.lit(""), "n"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


FAILING = ("label set", "edge typing", "missing")


def sweep(graph: Graph, expected: DataFrame, domains: DataFrame, wanted: DataFrame) -> DataFrame:
    """All checks of a graph at rest: (check, subject, n, failing).

    Label sets that no class has, edges whose ends don't fit and missing
    reference nodes fail a sweep; stubs and nodes without edges are told only.
    """
    sets = label_set_findings(graph, expected).select(F.lit("label set").alias("check"), F.col("labels").alias("subject"), "n")
    faults = edge_typing_faults(graph, domains).where("start_faults + end_faults > 0").select(F.lit("edge typing"), "type", F.col("start_faults") + F.col("end_faults"))
    missing = missing_nodes(graph, wanted).groupBy("key_label").agg(F.count("*").alias("n")).select(F.lit("missing"), "key_label", "n")
    empty = stubs(graph, wanted.select(*NODE_KEY)).groupBy("key_label").agg(F.count("*").alias("n")).select(F.lit("stub"), "key_label", "n")
    alone = orphans(graph).join(stubs(graph).select(*NODE_KEY), NODE_KEY, "left_semi").groupBy("key_label").agg(F.count("*").alias("n")).select(F.lit("orphan stub"), "key_label", "n")
    rows = sets.union(faults).union(missing).union(empty).union(alone)
    return rows.withColumn("failing", F.col("check").isin(*FAILING))


def cached_schema(graph: Graph, ancestors: Mapping[str, Sequence[str]], path: str, refresh: bool = False) -> tuple[DataFrame, str]:
    """The schema and how it came: HIT, MISSING, STALE, INVALID or REFRESHED. It is kept at ``path`` under the graph's fingerprint."""
    spark = graph.nodes.sparkSession
    now = fingerprint(graph).first()[0]
    status = "REFRESHED"
    if not refresh:
        try:
            kept = spark.read.parquet(path)
            marks = [r.fingerprint for r in kept.select("fingerprint").distinct().limit(2).collect()]
            status = "HIT" if marks == [now] else "STALE"
            found = kept.select("part", "name", "detail", "n")
        except AnalysisException as e:
            status = "MISSING" if "PATH_NOT_FOUND" in str(e) else "INVALID"
        if status == "HIT":
            return found, status
    schema(graph, ancestors).withColumn("fingerprint", F.lit(now)).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).select("part", "name", "detail", "n"), status


def foreign_rows(rows: DataFrame, column: str, universe_labels: Sequence[str]) -> DataFrame:
    """Rows of a result whose node in ``column`` (a struct with labels) has none of a universe's labels; a guarded query may not return any."""
    return rows.where(F.col(column).isNotNull() & ~F.arrays_overlap(F.col(f"{column}.labels"), F.array(*map(F.lit, universe_labels))))


def shown(names: Column, most: int) -> Column:
    """The first names of a sorted list, and how many more there are."""
    rest = F.size(names) - most
    return F.concat(F.array_join(F.slice(names, 1, most), ", "), F.when(rest > 0, F.concat(F.lit(" and "), rest.cast("string"), F.lit(" more"))).otherwise(""))
