"""Fixity of WARC files by Merkle trees (DataFrame functions only).

Pages are WARC records, records lie in files in order, each at an offset. The
records of an id, mostly one, have a leaf that hashes their hashes; its place
follows from the id alone, so that a record more or less moves no other leaf. A
node hashes the leaves of FAN neighbouring places, and so on up to one root
over all files. Two replicas agree if their roots do; if not, only branches
whose hashes differ are followed down, level by level, to the leaves that
differ, and there records are compared by their hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.llm.common import hash_bucket, written

FAN = 16
#: Page ids in a file; rows without an id lie in files of their own.
PER_FILE = 4096


def warc_record(url: Column, html: Column) -> Column:
    """A response record's text; null url and html are empty."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n"))


def leaves(pages: DataFrame, name: str = "warc") -> DataFrame:
    """(file, place, page_id, offset, length, hash, nth) of each record.

    Files hold PER_FILE ids each; within a file records follow one another by
    id, ties by hash, and the place is the id's in the file's range of ids.
    Rows without an id go to one of 64 files numbered below 0, and there to a
    place, by their url. ``nth`` numbers equal records of a place. Only
    page_id, url and html are read.
    """
    record = warc_record(F.col("url"), F.col("html"))
    id_, by_url = F.col("page_id").cast("long"), hash_bucket(F.col("url"), 64 * PER_FILE)
    place = F.coalesce(F.pmod(id_, F.lit(PER_FILE)), F.floor(by_url / 64)).cast("long")
    file = F.coalesce(F.floor((id_ - F.pmod(id_, F.lit(PER_FILE))) / PER_FILE), -1 - by_url % 64).cast("long")
    rows = pages.select(file.alias("file"), place.alias("place"), id_.alias("page_id"), F.octet_length(record).cast("long").alias("length"), F.sha2(record.cast("binary"), 256).alias("hash"))
    order = Window.partitionBy("file").orderBy("page_id", "hash")
    offset = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    nth = F.row_number().over(Window.partitionBy("file", "place", "hash").orderBy("length")).cast("long")
    return written(rows.select("file", "place", "page_id", offset.alias("offset"), "length", "hash", nth.alias("nth")), name)


def _parents(nodes: DataFrame) -> DataFrame:
    """The next level of (file, place, hash); a file of one node joins others by the file's number."""
    up = nodes.select(F.col("file"), F.floor(F.col("place") / FAN).alias("up"), "place", "hash")
    children = F.array_sort(F.collect_list(F.struct("place", "hash")))
    return up.groupBy("file", F.col("up").alias("place")).agg(F.sha2(F.array_join(F.transform(children, lambda x: x["hash"]), ""), 256).alias("hash"))


def tree(leaf: DataFrame, name: str = "warc") -> list[DataFrame]:
    """Levels of (file, place, hash), leaves first. Within files the place counts; above, files do, as places of file 0."""
    most = leaf.agg(F.max(F.abs("file"))).first()[0]
    levels = [leaf.groupBy("file", "place").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("hash")), ""), 256).alias("hash"))]
    if most is None:
        return levels
    places, files = PER_FILE - 1, 2 * most + 1
    while places > 0:
        places //= FAN
        levels.append(_parents(levels[-1]))
    # from here on a file is a place; negative numbers interleave
    number = F.when(F.col("file") >= 0, 2 * F.col("file")).otherwise(-2 * F.col("file") - 1)
    levels.append(written(levels.pop().select(F.lit(0).cast("long").alias("file"), number.alias("place"), "hash", F.col("file").alias("_file")), f"{name}-files"))
    below = levels[-1].drop("_file")
    levels.append(below)
    while files > 0:
        files //= FAN
        levels.append(_parents(levels[-1]))
    return levels


def damaged(first: list[DataFrame], second: list[DataFrame]) -> DataFrame:
    """(file, place, first_hash, second_hash) of leaves that differ or that one replica lacks.

    Compares from the root down; a level's nodes are read only below nodes
    that differ.
    """
    if len(first) != len(second):  # of different depth: no node of one answers to one of the other
        first, second = first[:1], second[:1]
    above: DataFrame | None = None
    for k in range(len(first) - 1, -1, -1):
        a, b = first[k], second[k]
        if "_file" in a.columns:
            # the step from files as places to files: same nodes, named anew
            files = a.select("place", "_file").union(b.select("place", "_file")).distinct()
            above = above.join(files, "place").select(F.col("_file").alias("file"), F.lit(0).cast("long").alias("place"))
            continue
        if above is not None:
            up = above.select("file", F.col("place").alias("_up"))
            a, b = (x.withColumn("_up", F.floor(F.col("place") / FAN)).join(up, ["file", "_up"], "left_semi").drop("_up") for x in (a, b))
        both = a.select("file", "place", F.col("hash").alias("first_hash")).join(b.select("file", "place", F.col("hash").alias("second_hash")), ["file", "place"], "full")
        above = both.where(~F.col("first_hash").eqNullSafe(F.col("second_hash")))
    return above


def audit(pages: DataFrame, replica: DataFrame) -> DataFrame:
    """Per record of ``pages``: where it lies, its hash, and whether the replica's differs or is missing; then the records only the replica has.

    Columns: page_id, file, offset, length, record_sha256, file_sha256,
    damaged. A record of the replica that has no counterpart of its id (or,
    without an id, of its place) counts as damaged and has no offset; length
    and hash are the replica's. Null ids, urls and texts and repeated rows are
    records like all others; an empty table gives an empty table.
    """
    leaf, other = leaves(pages, "warc-first"), leaves(replica, "warc-second")
    first, second = tree(leaf, "warc-first"), tree(other, "warc-second")
    key = ["file", "place", "hash", "nth"]
    differ = written(damaged(first, second).select("file", "place"), "warc-differ")
    ours, theirs = (x.join(differ, ["file", "place"], "left_semi") for x in (leaf, other))
    lost = written(ours.join(theirs.select(key), key, "left_anti").select(key), "warc-lost")
    found = theirs.join(ours.select(key), key, "left_anti").withColumn("_nth", F.row_number().over(Window.partitionBy("file", "place").orderBy("hash", "nth")))
    changed = lost.groupBy("file", "place").agg(F.count("*").alias("_changed"))
    added = found.join(changed, ["file", "place"], "left").where(F.col("_nth") > F.coalesce("_changed", F.lit(0)))
    roots = leaf.select("file", "hash").limit(0)
    for level in first:
        if "_file" in level.columns:
            roots = level.select(F.col("_file").alias("file"), "hash")
    kept = leaf.join(lost.withColumn("damaged", F.lit(True)), key, "left").select("page_id", "file", "offset", "length", "hash", F.coalesce("damaged", F.lit(False)).alias("damaged"))
    rows = kept.unionByName(added.select("page_id", "file", F.lit(None).cast("long").alias("offset"), "length", "hash", F.lit(True).alias("damaged")))
    rows = rows.join(roots.select("file", F.col("hash").alias("file_sha256")), "file", "left")
    return rows.select("page_id", "file", "offset", "length", F.col("hash").alias("record_sha256"), "file_sha256", "damaged")
