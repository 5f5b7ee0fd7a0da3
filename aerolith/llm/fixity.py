"""Merkle fixity audit of WARC archives.

Records lie in archives one behind the other. A leaf is a record: its key, its range of offsets and the SHA-256 of its
bytes. A node covers an ordered range of offsets and hashes the lengths and hashes of its children in that order. Which
records a node covers follows from their keys, not from how many lie in front: a node of level k ends before a record
whose key's hash is divisible by fan_out to the k. So where a replica has lost or gained records, those behind them, though
they have moved, stay in nodes that agree. Above the archives' roots stands one more tree over the archives' numbers. To
compare two replicas, roots are compared first, and then only children of nodes that differ, down to the records; trees
of unlike heights are compared from the top of the lower one on.

Cases: null fields are empty in a record; equal rows are records of their own, told apart by how many of their id lie in
front; an empty record is a header alone; an empty table has no tree, all of the other's records are missing or extra, and
two empty ones have nothing to report; a record that one replica lacks is reported as missing or extra, at its place in
the one that has it.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

END = "\r\n"


@dataclass(frozen=True)
class FixityConfig:
    archive_records: int = 1024
    fan_out: int = 16


def record(record_id: Column, uri: Column, payload: Column) -> Column:
    """A WARC record as a string; its bytes are its UTF-8."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.0{END}WARC-Type: resource{END}WARC-Record-ID: <urn:page:"), text(record_id), F.lit(f">{END}WARC-Target-URI: "), text(uri),
        F.lit(f"{END}Content-Length: "), F.octet_length(text(payload)).cast("string"), F.lit(END + END),
    )
    return F.concat(head, text(payload), F.lit(END + END))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """Headers, payload, offset and length of each record of an archive; raises ValueError where it is malformed."""
    at = 0
    while at < len(data):
        head_end = data.find(b"\r\n\r\n", at)
        if head_end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at offset {at}")
        lines = data[at:head_end].decode().split(END)[1:]
        headers = dict(x.split(": ", 1) for x in lines)
        begin = head_end + 4
        end = begin + int(headers["Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at offset {at} is cut short")
        yield headers, data[begin:end], at, end + 4 - at
        at = end + 4


def parse_all(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int, str | None]]:
    """As parse(), but what is malformed becomes a record of its own, with an error, up to the next record's beginning."""
    at = 0
    while at < len(data):
        error, done = None, at
        try:
            for headers, payload, offset, length in parse(data[at:]):
                yield headers, payload, at + offset, length, None
                done = at + offset + length
        except (ValueError, KeyError) as e:
            error = f"{type(e).__name__}: {e}"
        if error is None:
            return
        end = data.find(b"\r\n\r\nWARC/", done)
        end = len(data) if end < 0 else end + 4
        yield {}, data[done:end], done, end - done, error
        at = end


def read_warc(spark, path: str) -> DataFrame:
    """archive (its path), record_id, uri, payload, offset, length and error (null: none) of the records of WARC files, plain or
    gzipped, a file a task; offsets are those of the plain bytes. A file has to fit into 2 GB."""
    import pyarrow as pa

    types = (pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.string())

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                content = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                rows = [(name, h.get("WARC-Record-ID", ""), h.get("WARC-Target-URI", ""), p, o, n, e) for h, p, o, n, e in parse_all(content)]
                for k in range(0, len(rows), 1000):
                    columns = zip(zip(*rows[k : k + 1000], strict=True), types, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["archive", "record_id", "uri", "payload", "offset", "length", "error"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "archive string, record_id string, uri string, payload binary, offset long, length long, error string")


def drawn(page_id: Column, digit: int, n) -> Column:
    """A number in [0, n) of an id, from eight hex digits of its MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(page_id.cast("string"), F.lit("")).cast("binary")), digit, 8), 16, 10).cast("long") % n


def lay_out(pages: DataFrame, config: FixityConfig = FixityConfig(), archives: int | None = None, rot: Column | None = None) -> DataFrame:
    """page_id, archive, key, place, offset, length, digest, and rotten: the digest after the first byte's case has changed.

    Where rot holds the record's bytes have changed so, and the digest is theirs; their order is that of the sound ones.
    Bytes are hashed where they are read; what moves is a row of numbers and digests a record.
    """
    archives = archives or archive_count(pages, config)
    rows = pages.select("page_id", drawn(F.col("page_id"), 1, archives).alias("archive"), record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    changed = F.concat(F.lit("w"), F.substring("record", 2, 2**31 - 1))
    sound, rotten = F.sha2("record", 256), F.sha2(changed, 256)
    hurt = F.lit(False) if rot is None else F.coalesce(rot, F.lit(False))
    rows = rows.select("page_id", "archive", F.octet_length("record").cast("long").alias("length"), sound.alias("sound"), F.when(hurt, rotten).otherwise(sound).alias("digest"), rotten.alias("rotten"))
    order, same = Window.partitionBy("archive").orderBy("page_id", "sound"), Window.partitionBy("archive").orderBy("page_id")
    place = (F.row_number().over(order) - 1).cast("long")
    offset = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    key = F.concat_ws("#", F.coalesce(F.col("page_id").cast("string"), F.lit("")), (F.col("place") - F.rank().over(same) + 1).cast("string"))
    return rows.withColumn("place", place).withColumn("offset", offset).withColumn("key", key).select("page_id", "archive", "key", "place", "offset", "length", "digest", "rotten")


def archive_count(pages: DataFrame, config: FixityConfig = FixityConfig()) -> int:
    return max(1, -(-pages.count() // config.archive_records))


NODE = ["archive", "level", "node", "parent_archive", "parent", "place", "low", "high", "hash"]


def build_tree(leaves: DataFrame, config: FixityConfig = FixityConfig()) -> tuple[DataFrame, int, int]:
    """All nodes, the level of the archives' roots and that of the highest node. leaves: archive, key, place, offset, length,
    digest. A node is named by the key that it begins with; the tree over archives has archive -1 and numbers for keys."""
    inner = 1
    while config.fan_out**inner < config.archive_records:
        inner += 1
    roots = inner + 1
    upto = Window.partitionBy("archive").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    begins = lambda k: F.pmod(F.xxhash64("key"), F.lit(config.fan_out**k)) == 0
    at = {f"p{k}": F.coalesce(F.last(F.when(begins(k), F.col("key")), True).over(upto), F.lit("")) for k in range(1, inner + 1)}
    up = [f"p{k}" for k in range(1, inner + 1)] + ["p_root", "p_none"]
    below = leaves.withColumns(at | {"p_root": F.lit(""), "p_none": F.lit(None).cast("string")})
    below = below.select("archive", F.col("key").alias("node"), "place", F.col("offset").alias("low"), (F.col("offset") + F.col("length")).alias("high"), F.sha2(F.concat_ws(":", "key", "length", "digest"), 256).alias("hash"), *up)
    shown = lambda df, level, parent_archive, parent: df.select("archive", F.lit(level).alias("level"), "node", parent_archive.alias("parent_archive"), parent.alias("parent"), "place", "low", "high", "hash")
    above = lambda n: F.floor(F.col(n).cast("long") / config.fan_out).cast("string")
    nodes = shown(below, 0, F.col("archive"), F.col(up[0]))

    def joined(df: DataFrame, by: list[str], rest: list[str]) -> DataFrame:
        child = F.sort_array(F.collect_list(F.struct("low", "node", (F.col("high") - F.col("low")).alias("length"), "hash")))
        said = F.array_join(F.transform(child, lambda x: F.concat_ws(":", x["length"], x["hash"])), "\n")
        return df.groupBy(*by).agg(F.min("place").alias("place"), F.min("low").alias("low"), F.max("high").alias("high"), F.sha2(said, 256).alias("hash"), *[F.first(c).alias(c) for c in rest])

    for k in range(1, roots + 1):
        rest = up[k:]
        below = joined(below, ["archive", up[k - 1]], rest).withColumnRenamed(up[k - 1], "node")
        top = k == roots
        nodes = nodes.unionByName(shown(below, k, F.lit(-1).cast("long") if top else F.col("archive"), above("archive") if top else F.col(up[k])))
    most, level = leaves.agg(F.max("archive").alias("x")).first()["x"] or 0, roots
    below = below.select(F.lit(-1).cast("long").alias("archive"), F.col("archive").cast("string").alias("node"), "place", "low", "high", "hash")
    while True:
        level, most = level + 1, most // config.fan_out
        # archives' own offsets begin at 0, so their order is that of their numbers
        below = joined(below.withColumn("up", above("node")).withColumn("low", F.lpad("node", 20, "0")).withColumn("high", F.lit(0)).withColumn("low", F.col("low").cast("long")), ["archive", "up"], []).withColumnRenamed("up", "node")
        nodes = nodes.unionByName(shown(below, level, F.col("archive"), above("node")))
        if most == 0:
            return materialise(nodes, "fixity-tree"), roots, level


def audit(one: tuple[DataFrame, int, int], two: tuple[DataFrame, int, int], config: FixityConfig = FixityConfig(), seen: dict[int, int] | None = None) -> DataFrame:
    """archive, place, low, high, status of the records that differ, are missing from two or extra in it. seen: gets how many
    nodes were compared at each level."""
    (a, _, top), (b, _, other) = one, two
    side = lambda t, k: t.filter(F.col("level") == k).select("archive", "node", "parent_archive", "parent", "place", "low", "high", "hash")
    differing = None
    for k in range(min(top, other), -1, -1):
        left, right = side(a, k), side(b, k)
        if differing is not None:
            parents = differing.select(F.col("archive").alias("parent_archive"), F.col("node").alias("parent"))
            left, right = (x.join(parents, ["parent_archive", "parent"], "left_semi") for x in (left, right))
        left = left.select("archive", "node", "place", "low", "high", "hash")
        right = right.select("archive", "node", *[F.col(c).alias(f"{c}2") for c in ("place", "low", "high", "hash")])
        met = left.join(right, ["archive", "node"], "full_outer")
        if seen is not None:
            seen[k] = met.count()
        met = met.filter(~F.col("hash").eqNullSafe(F.col("hash2")))
        if k:
            differing = materialise(met.select("archive", "node"), "fixity-differing")
            if differing.isEmpty():
                return met.limit(0).select("archive", "place", "low", "high", F.lit("").alias("status"))
    status = F.when(F.col("hash2").isNull(), "missing").when(F.col("hash").isNull(), "extra").otherwise("differs")
    return met.select("archive", *[F.coalesce(c, f"{c}2").alias(c) for c in ("place", "low", "high")], status.alias("status"))


def audit_pages(pages: DataFrame, rot_one_in: int = 97, rot_archives: int = 4, config: FixityConfig = FixityConfig()) -> DataFrame:
    """Per page: its record's archive, offset, length and digest, and whether a replica still holds the same bytes.

    The replica is read and hashed for itself. It is the same archives after rot: in one archive of rot_archives the first
    byte of about one record in rot_one_in has changed its case.
    """
    archives = archive_count(pages, config)
    rot = (drawn(F.col("page_id"), 1, archives) % rot_archives == 0) & (drawn(F.col("page_id"), 9, rot_one_in) == 0)
    laid = materialise(lay_out(pages, config, archives).drop("rotten"), "fixity-records")
    replica = materialise(lay_out(pages, config, archives, rot).drop("rotten"), "fixity-replica")
    broken = audit(build_tree(laid, config), build_tree(replica, config), config)
    broken = broken.select("archive", "place", "status")
    return laid.join(broken, ["archive", "place"], "left").select("page_id", "archive", "offset", "length", "digest", F.col("status").isNull().alias("intact"))
