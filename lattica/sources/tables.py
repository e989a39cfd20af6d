"""Pinned snapshots: CSV files and pages checked by hash, wiki exports, manifests, and the graph's own snapshots."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.functions.naming import hex_of_base36
from lattica.operators.graph import Graph


class ChangedSource(ValueError):
    """A source's bytes are not those that were pinned."""


def read_pinned_csv(spark: SparkSession, path: str, sha256: str) -> DataFrame:
    """A CSV file, all columns text, after its hash has been checked on the executors."""
    found = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("h")).first()
    if found is None or found.h != sha256:
        raise ChangedSource(f"{path}: hash is {found.h if found else 'missing'}")
    return spark.read.option("header", True).option("inferSchema", False).option("escape", '"').option("multiLine", True).csv(path)


PAGE = "title string, page_id long, revision_id long, timestamp timestamp, sha1 string, page_type string, wikitext string"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE).json(path)


def page_mismatch(pages: DataFrame, pins: DataFrame) -> DataFrame:
    """(page_id, problem) of pins without an intact page: missing, another revision, another recorded or actual hash."""
    p = pages.select("page_id", F.col("revision_id").alias("_r"), F.col("sha1").alias("_s"), F.sha1("wikitext").alias("_h"))
    rows = pins.join(p, "page_id", "left")
    problem = F.when(F.col("_r").isNull(), "missing").when(F.col("_r") != F.col("revision_id"), "revision").when(F.col("_s") != F.col("sha1"), "recorded hash").when(F.col("_h") != F.col("sha1"), "content hash")
    return rows.select("page_id", problem.alias("problem")).where("problem is not null")


def unpinned_pages(pages: DataFrame, pins: DataFrame) -> DataFrame:
    """Intact pages that no pin names."""
    return pages.join(pins.select("page_id"), "page_id", "left_anti").where(F.sha1("wikitext") == F.col("sha1"))


def manifest_pins(spark: SparkSession, path: str) -> DataFrame:
    """(page_type, title, page_id, revision_id, sha1) of a manifest of pins by page type; no rows where there is no file."""
    kind = "struct<page_types:map<string,array<struct<title:string,page_id:bigint,revision_id:bigint,sha1:string>>>>"
    _, target, fs = _hadoop(spark, path)
    if not fs.exists(target):
        return spark.createDataFrame([], "page_type string, title string, page_id long, revision_id long, sha1 string")
    text = spark.read.option("wholetext", True).text(path).select(F.from_json("value", kind).alias("m"))
    return text.select(F.explode("m.page_types").alias("page_type", "pins")).select("page_type", F.inline("pins"))


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a wiki export, with hashes in hexadecimal and whether they hold. A page with any other number of revisions than one is an error when it is read."""
    schema = "title string, ns int, id long, revision array<struct<id:long,timestamp:timestamp,text:string,sha1:string>>"
    rows = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    only = F.when(F.size("revision") == 1, F.col("revision")[0]).otherwise(F.raise_error(F.concat(F.lit("one revision expected of "), F.col("title"))))
    rows = rows.withColumn("revision", only)
    digest = F.lpad(hex_of_base36(F.col("revision.sha1")), 40, "0")
    text = F.coalesce(F.col("revision.text"), F.lit(""))
    return rows.select("title", F.col("ns").alias("namespace"), F.col("id").alias("page_id"), F.col("revision.id").alias("revision_id"), "revision.timestamp", digest.alias("sha1"), text.alias("wikitext"), (F.sha1(text) == digest).alias("intact"))


class StaleSnapshot(RuntimeError):
    """Another writer has moved the pointer since the snapshot that a write started from."""


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that the pointer names; null where nothing was committed yet."""
    path = f"{root}/current.json"
    _, target, fs = _hadoop(spark, path)
    return _read_json(spark, path)["version"] if fs.exists(target) else None


def commit_graph(spark: SparkSession, graph: Graph, root: str, after: str | None = None) -> str:
    """Writes a snapshot, partitioned by universe, then moves the pointer to it: readers see the old one or the new one.

    ``after`` is the version that the write started from; if the pointer has
    moved since, the write is refused and the snapshot stays unnamed.
    """
    version = uuid.uuid4().hex
    graph.nodes.write.partitionBy("universe").parquet(f"{root}/{version}/nodes")
    graph.edges.write.partitionBy("universe", "type").parquet(f"{root}/{version}/edges")
    about = {"version": version, "nodes": graph.nodes.schema.jsonValue(), "edges": graph.edges.schema.jsonValue()}
    _write_text(spark, f"{root}/{version}/schema.json", json.dumps(about))
    if after is not None and current_version(spark, root) != after:
        raise StaleSnapshot(f"{root} has moved on from {after}")
    replace_file(spark, f"{root}/current.json", json.dumps({"version": version}))
    return version


def scratch(spark: SparkSession) -> str:
    """A folder for tables that needn't last: the session's checkpoint folder or, where all tasks run on this machine and none is set, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"file://{tempfile.mkdtemp(prefix='lattica-')}"


def settled(graph: Graph) -> Graph:
    """The graph as written tables in the scratch folder: what follows neither repeats nor stacks up what led to it."""
    spark = graph.nodes.sparkSession
    root = f"{scratch(spark)}/graph-{uuid.uuid4().hex}"
    graph.nodes.write.parquet(f"{root}/nodes")
    graph.edges.write.parquet(f"{root}/edges")
    return Graph(spark.read.schema(graph.nodes.schema).parquet(f"{root}/nodes"), spark.read.schema(graph.edges.schema).parquet(f"{root}/edges"))


def _hadoop(spark: SparkSession, path: str):  # noqa: ANN202
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    _, target, fs = _hadoop(spark, path)
    stream = fs.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file written beside its place, then moved there: readers see the old text or the new one."""
    fresh = f"{path}-{uuid.uuid4().hex}.new"
    _write_text(spark, fresh, text)
    jvm, target, _ = _hadoop(spark, path)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(jvm.org.apache.hadoop.fs.Path(fresh), target, options)


def _read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.option("wholetext", True).text(path).first()[0])


def read_graph(spark: SparkSession, root: str, version: str | None = None) -> Graph:
    """The current snapshot, or the one asked for."""
    version = version or _read_json(spark, f"{root}/current.json")["version"]
    about = _read_json(spark, f"{root}/{version}/schema.json")  # a table without rows has no files that tell its columns
    nodes, edges = (spark.read.schema(T.StructType.fromJson(about[name])).parquet(f"{root}/{version}/{name}") for name in ("nodes", "edges"))
    from lattica.operators.graph import EDGE_KEY

    return Graph(nodes.select("universe", "key_label", "id", "leaf", "labels", "name", "props"), edges.select(*EDGE_KEY, "props"))


def canonical_json(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """Rows as JSON with sorted keys, in a fixed order: equal tables give equal text."""
    return df.select(F.to_json(F.struct(*sorted(df.columns))).alias("json"), *order).orderBy(*[c if isinstance(c, str) else c for c in order]).select("json")


def questions(spark: SparkSession, sets: Mapping[str, str]) -> DataFrame:
    """Evaluation questions of TOML texts, by set; ids must differ within and between sets."""
    import hashlib
    import tomllib

    rows = []
    for name, text in sets.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        for k, q in enumerate(tomllib.loads(text).get("questions", [])):
            rows.append((name, k, str(q["id"]), q.get("family"), q["question"], q.get("reference"), q.get("gold_query"), digest))
    ids = [r[2] for r in rows]
    if twice := sorted({i for i in ids if ids.count(i) > 1}):
        raise ValueError(f"question ids repeat: {', '.join(twice)}")
    return spark.createDataFrame(rows, "set string, seq int, id string, family string, question string, reference string, gold_query string, sha256 string")
