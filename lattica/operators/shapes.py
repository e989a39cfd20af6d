"""Shape rules over a batch, projected to facts: one pass over the facts, whatever the number of rules.

A fact is (subject, path, value, datatype, classes): a property of a node, an
edge to another node, whose classes stand in ``classes``, or a property of an
edge, whose subject is the edge itself. A rule's atoms each say how many values
of a path a subject has and what they must be. Facts are counted by subject and
atom with partial aggregation, so no subject's facts are brought together;
alternatives are decided from the few atoms that they consist of.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.operators.graph import Graph
from lattica.operators.validate import VIOLATION, Ontology

ALWAYS = "*"
_TYPES = {"int": "integer", "bigint": "integer", "smallint": "integer", "tinyint": "integer", "double": "decimal", "float": "decimal", "boolean": "boolean", "string": "string"}


@dataclass(frozen=True)
class Atom:
    """Values of ``path``: how many, of which datatype or class, in which range, list or form. ``not_among`` holds values that must not occur."""

    path: str
    least: int = 0
    most: int | None = None
    datatype: str | None = None
    low: float | None = None
    high: float | None = None
    above: float | None = None
    among: tuple[str, ...] = ()
    not_among: tuple[str, ...] = ()
    cls: str | None = None
    form: str | None = None

    def breaks(self) -> Column:
        """Whether a fact of the path is none that it should be."""
        value, number = F.col("value"), F.col("value").cast("double")
        bad = [F.lit(False)]
        if self.datatype:
            bad.append(~F.coalesce(F.col("datatype") == self.datatype, F.lit(False)))
        for limit, wrong in ((self.low, lambda x: number < x), (self.high, lambda x: number > x), (self.above, lambda x: number <= x)):
            if limit is not None:
                bad.append(wrong(limit) | number.isNull())
        if self.among:
            bad.append(~value.isin(list(self.among)))
        if self.not_among:
            bad.append(value.isin(list(self.not_among)))
        if self.cls:
            bad.append(~F.coalesce(F.array_contains("classes", self.cls), F.lit(False)))
        if self.form:
            bad.append(~value.rlike(self.form))
        return reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in bad])


@dataclass(frozen=True)
class IsA:
    """The subject is of a class."""

    cls: str


@dataclass(frozen=True)
class Choice:
    """Alternatives, each a tuple of conditions that must all hold: one at least, or just one."""

    options: tuple[tuple[Atom | IsA, ...], ...]
    just_one: bool = False


@dataclass(frozen=True)
class Together:
    """Two numbers, both or neither; the first is ``low`` at least and no more than the second. Not ``both``: only ordered where both are."""

    first: str
    second: str
    low: float | None = None
    both: bool = True


@dataclass(frozen=True)
class Apart:
    """No value belongs to two of the paths; with ``both``, either all of the paths have values or none."""

    paths: tuple[str, ...]
    both: bool = False


@dataclass(frozen=True)
class Needs:
    """A subject with any of ``paths`` has ``value`` under ``path``."""

    paths: tuple[str, ...]
    path: str
    value: str


@dataclass(frozen=True)
class Shape:
    """A rule for nodes of ``classes``, for subjects of the path ``having``, or for edges of ``predicate``. ``scope``: classes whose batches it checks."""

    rule_id: str
    message: str
    checks: tuple[Atom | IsA | Choice | Together | Apart | Needs, ...]
    classes: tuple[str, ...] = ()
    predicate: str | None = None
    having: str | None = None
    scope: tuple[str, ...] = ()


def property_name(type_: Column) -> Column:
    """HAS_DAMAGE_CLASS as hasDamageClass."""
    words = F.split(F.lower(type_), "_")
    return F.concat(F.element_at(words, 1), F.array_join(F.transform(F.slice(words, 2, F.size(words)), F.initcap), ""))


def subject_of(label: Column, id_: Column) -> Column:
    return F.concat(label, F.lit("/"), id_)


def _facts_of(values: Column, path: str, type_: str) -> Column:
    return F.transform(F.filter(values, lambda v: v.isNotNull()), lambda v: F.struct(F.lit(path).alias("path"), v.cast("string").alias("value"), F.lit(type_).alias("datatype")))


def _property_facts(rows: DataFrame, struct: str) -> DataFrame:
    """(subject, path, value, datatype) of the struct's fields that have values; lists give one fact a member."""
    parts = []
    for f in rows.schema[struct].dataType.fields:
        kind = f.dataType.simpleString()
        inner = kind[6:-1] if kind.startswith("array<") else kind
        values = F.col(f"{struct}.{f.name}") if kind.startswith("array<") else F.array(F.col(f"{struct}.{f.name}"))
        type_ = "decimal" if inner.startswith("decimal") else _TYPES.get(inner, inner)
        parts.append(_facts_of(values, f.name, type_))
    lists = F.flatten(F.filter(F.array(*parts), lambda x: x.isNotNull())) if parts else F.expr("cast(array() as array<struct<path:string,value:string,datatype:string>>)")
    return rows.select("subject", F.explode(lists).alias("f")).select("subject", "f.path", "f.value", "f.datatype")


def project(graph: Graph, ontology: Ontology, slots: Mapping[str, tuple[str, Mapping[str, str]]] = {}, inverse: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(facts, subjects) of a batch.

    ``slots`` tells for an edge type the property that names its path instead
    of the type, such as a slot number; that property is no fact of the edge
    then. ``inverse`` paths are also facts of their end, under ``^path``.
    subjects: subject, label, id, classes, predicate (of an edge that is one).
    """
    above = F.create_map(*[x for c, up in sorted(ontology.ancestors.items()) for x in (F.lit(c), F.array(*map(F.lit, sorted({c, *up}))))])
    classes = lambda label: F.coalesce(F.element_at(above, label), F.array(label))
    nodes = graph.nodes.withColumn("subject", subject_of(F.col("key_label"), F.col("id")))
    none = F.lit(None).cast("array<string>")
    ids = nodes.select("subject", F.lit("id").alias("path"), F.col("id").alias("value"), F.lit("string").alias("datatype"))
    own = ids.unionByName(_property_facts(nodes, "props")).withColumn("classes", none)
    edges = graph.edges.withColumn("path", property_name(F.col("type")))
    fields = [f.name for f in graph.edges.schema["props"].dataType.fields]
    for type_, (field, paths) in slots.items():
        named = F.element_at(F.create_map(*[F.lit(x) for pair in paths.items() for x in pair]), F.col(f"props.{field}").cast("string"))
        edges = edges.withColumn("path", F.when(F.col("type") == type_, F.coalesce(named, F.col("path"))).otherwise(F.col("path")))
        edges = edges.withColumn("props", F.struct(*[(F.when(F.col("type") != type_, F.col(f"props.{f}")) if f == field else F.col(f"props.{f}")).alias(f) for f in fields]))
    src, dst = subject_of(F.col("src_label"), F.col("src_id")), subject_of(F.col("dst_label"), F.col("dst_id"))
    out = edges.select(src.alias("subject"), "path", F.col("dst_id").alias("value"), F.lit(None).cast("string").alias("datatype"), classes(F.col("dst_label")).alias("classes"))
    back = edges.where(F.col("path").isin(list(inverse))).select(dst.alias("subject"), F.concat(F.lit("^"), F.col("path")).alias("path"), F.col("src_id").alias("value"), F.lit(None).cast("string").alias("datatype"), classes(F.col("src_label")).alias("classes"))
    as_node = edges.withColumn("subject", F.concat_ws("\x01", src, F.col("path"), dst))
    objects = as_node.select("subject", F.lit("object").alias("path"), F.col("dst_id").alias("value"), F.lit(None).cast("string").alias("datatype"), classes(F.col("dst_label")).alias("classes"))
    facts = own.unionByName(out).unionByName(back).unionByName(objects)
    if fields:
        facts = facts.unionByName(_property_facts(as_node, "props").withColumn("classes", none))
    subjects = nodes.select("subject", F.col("key_label").alias("label"), "id", classes(F.col("leaf")).alias("classes"), F.lit(None).cast("string").alias("predicate"))
    subjects = subjects.unionByName(as_node.select("subject", F.col("src_label").alias("label"), F.col("src_id").alias("id"), F.array().cast("array<string>").alias("classes"), F.col("path").alias("predicate")))
    return facts, subjects


def select_shapes(shapes: Sequence[Shape], scope: Iterable[str], ontology: Ontology) -> list[Shape]:
    """Rules whose scope holds a class of ``scope`` or an ancestor of one, and those that always run."""
    reached = {a for c in scope for a in (c, *ontology.ancestors.get(c, ()))}
    return [s for s in shapes if ALWAYS in (s.scope or s.classes) or reached & set(s.scope or s.classes)]


def inverse_paths(shapes: Sequence[Shape]) -> set[str]:
    return {a.path[1:] for s in shapes for a in _atoms(s) if isinstance(a, Atom) and a.path.startswith("^")}


def _atoms(shape: Shape) -> list[Atom | IsA]:
    out: list[Atom | IsA] = []
    for c in shape.checks:
        if isinstance(c, Choice):
            out += [a for option in c.options for a in option]
        elif isinstance(c, Atom | IsA):
            out.append(c)
    return out


def _targets(shape: Shape) -> Column:
    if shape.predicate:
        return F.coalesce(F.col("predicate") == shape.predicate, F.lit(False))
    node = F.col("predicate").isNull()
    return node & F.arrays_overlap("classes", F.array(*map(F.lit, shape.classes))) if shape.classes else node


def run_shapes(facts: DataFrame, subjects: DataFrame, shapes: Sequence[Shape]) -> DataFrame:
    """Violations of all rules. An empty batch has none."""
    spark = facts.sparkSession
    out = spark.createDataFrame([], VIOLATION)
    atoms: list[Atom] = []
    numbers: dict[Atom, int] = {}
    for s in shapes:
        for a in _atoms(s):
            if isinstance(a, Atom) and a not in numbers:
                numbers[a] = len(atoms)
                atoms.append(a)
    counted = None
    if atoms:
        hits = F.filter(F.array(*[F.when(F.col("path") == a.path, F.struct(F.lit(k).alias("atom"), a.breaks().alias("bad"))) for k, a in enumerate(atoms)]), lambda x: x.isNotNull())
        rows = facts.where(F.col("path").isin(sorted({a.path for a in atoms}))).select("subject", "value", F.explode(hits).alias("h"))
        counted = rows.groupBy("subject", F.col("h.atom").alias("atom")).agg(F.count("*").alias("n"), F.count_if(F.col("h.bad")).alias("bad"), F.min(F.when(F.col("h.bad"), F.col("value"))).alias("odd"))
    # what a rule asks of its subjects one by one: all rules in one join
    direct = [(s, a) for s in shapes if not s.having for a in s.checks if isinstance(a, Atom)]
    if direct:
        asked = [F.when(_targets(s), F.struct(F.lit(numbers[a]).alias("atom"), F.lit(a.least).alias("least"), F.lit(a.most).cast("int").alias("most"), F.lit(s.rule_id).alias("rule_id"), F.lit(a.path).alias("property_name"), F.lit(s.message).alias("message"))) for s, a in direct]
        rows = subjects.select("subject", "label", "id", F.explode(F.filter(F.array(*asked), lambda x: x.isNotNull())).alias("a")).select("subject", "label", "id", "a.*")
        rows = rows.join(counted, ["subject", "atom"], "left")
        n = F.coalesce("n", F.lit(0))
        rows = rows.where((n < F.col("least")) | F.coalesce(n > F.col("most"), F.lit(False)) | (F.coalesce("bad", F.lit(0)) > 0))
        value = F.coalesce("odd", F.concat(n.cast("string"), F.lit(" values")))
        out = out.unionByName(rows.select("rule_id", F.col("label").alias("class_label"), "id", "property_name", value.alias("value"), "message"))
    for s in shapes:
        found = subjects.where(_targets(s))
        if s.having:
            found = found.join(facts.where(F.col("path") == s.having).select("subject").distinct(), "subject", "left_semi")
        for check in s.checks:
            if s.having or not isinstance(check, Atom):
                out = out.unionByName(_run_check(check, s, found, facts, counted, numbers))
    return out


def _violations(rows: DataFrame, shape: Shape, path: str | None, value: Column) -> DataFrame:
    return rows.select(F.lit(shape.rule_id).alias("rule_id"), F.col("label").alias("class_label"), "id", F.lit(path).cast("string").alias("property_name"), value.cast("string").alias("value"), F.lit(shape.message).alias("message"))


def _holds(found: DataFrame, counted: DataFrame, atom: Atom, number: int) -> DataFrame:
    """``found`` with _n, _odd and _ok: whether the atom holds."""
    own = counted.where(F.col("atom") == number).select("subject", F.col("n").alias("_n"), F.col("bad").alias("_bad"), F.col("odd").alias("_odd"))
    n = F.coalesce("_n", F.lit(0))
    ok = (n >= atom.least) & (F.coalesce("_bad", F.lit(0)) == 0)
    if atom.most is not None:
        ok &= n <= atom.most
    return found.join(own, "subject", "left").withColumn("_ok", ok).withColumn("_n", n).drop("_bad")


def _run_check(check: object, shape: Shape, found: DataFrame, facts: DataFrame, counted: DataFrame | None, numbers: Mapping[Atom, int]) -> DataFrame:
    if isinstance(check, Atom):
        rows = _holds(found, counted, check, numbers[check]).where(~F.col("_ok"))
        return _violations(rows, shape, check.path, F.coalesce(F.col("_odd"), F.concat(F.col("_n").cast("string"), F.lit(" values"))))
    if isinstance(check, IsA):
        return _violations(found.where(~F.array_contains("classes", check.cls)), shape, None, F.array_join("classes", "|"))
    if isinstance(check, Choice):
        rows, options, k = found, [], 0
        for option in check.options:
            every = []
            for a in option:
                if isinstance(a, IsA):
                    every.append(F.array_contains("classes", a.cls))
                else:
                    rows = _holds(rows, counted, a, numbers[a]).withColumnRenamed("_ok", f"_ok{k}").drop("_n", "_odd")
                    every.append(F.col(f"_ok{k}"))
                    k += 1
            options.append(reduce(lambda a, b: a & b, every).cast("int"))
        held = reduce(lambda a, b: a + b, options)
        return _violations(rows.where(held != 1 if check.just_one else held < 1), shape, None, held)
    if isinstance(check, Needs):
        has = facts.where(F.col("path").isin(list(check.paths))).select("subject").distinct()
        given = facts.where((F.col("path") == check.path) & (F.col("value") == check.value)).select("subject").distinct()
        return _violations(found.join(has, "subject", "left_semi").join(given, "subject", "left_anti"), shape, check.path, F.lit(check.value))
    if isinstance(check, Together):
        number = F.col("value").cast("double")
        of = lambda p: F.when(F.col("path") == p, number)
        ends = facts.where(F.col("path").isin(check.first, check.second)).groupBy("subject").agg(F.max(of(check.first)).alias("_a"), F.min(of(check.second)).alias("_b"))
        bad = F.coalesce(F.col("_a") > F.col("_b"), F.lit(False))
        if check.both:
            bad |= F.col("_a").isNull() != F.col("_b").isNull()
        if check.low is not None:
            bad |= F.coalesce(F.col("_a") < check.low, F.lit(False))
        return _violations(found.join(ends, "subject").where(bad), shape, check.first, F.concat_ws("/", "_a", "_b"))
    assert isinstance(check, Apart)
    used = facts.where(F.col("path").isin(list(check.paths)))
    shared = used.groupBy("subject", "value").agg(F.count_distinct("path").alias("_paths")).where("_paths > 1").select("subject", "value")
    bad = shared.groupBy("subject").agg(F.min("value").alias("_v"))
    if check.both:
        few = used.groupBy("subject").agg(F.count_distinct("path").alias("_paths")).where(F.col("_paths") < len(check.paths)).select("subject", F.lit(None).cast("string").alias("_v"))
        bad = bad.unionByName(few)
    return _violations(found.join(bad, "subject"), shape, check.paths[0], F.col("_v"))
