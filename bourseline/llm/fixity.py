"""Merkle fixity audit of WARC replicas.

`records` turns pages into WARC response records, laid out in files of `FILE_RECORDS`
records each, with the byte offset of each record in its file. `tree` hashes records into
the ordered offset ranges of a file (`RANGE_BYTES` each; a record belongs to the range in
which it begins), ranges into files, and files, `FANOUT` at a time, up to one root. A
range's hash covers the offsets and lengths of its records too, so ranges whose records
are the same but lie elsewhere differ. Only hashes are stored, by level.

`audit` compares the roots of two replicas and goes down one level at a time, comparing
only the children of nodes that differ, to the records that are changed, moved (the same
bytes at another offset), missing or extra.

Cases: a null url or html is an empty one; rows with a null or repeated id are records
like any other, in an order that only their content decides; a replica may lack whole files; two empty
replicas agree; an empty one against one with records reports them all; only the named
columns are read, so extra columns cannot clash; html of any length is hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourseline.sources.storage import stage

FILE_RECORDS = 1000
RANGE_BYTES = 1 << 18
FANOUT = 16


def records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """`file`, `key` and `record` (the bytes: WARC head, empty line, html, two empty lines)."""
    body = F.coalesce(F.col(html), F.lit(""))
    name = F.sha2(F.concat_ws("\n", F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(url), F.lit(""))).cast("binary"), 256)
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:sha256:"), name,
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(F.col(url), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    file = F.coalesce(F.floor(F.col(key) / FILE_RECORDS), F.lit(-1)).cast("long")
    return pages.select(file.alias("file"), F.col(key).alias("key"), F.concat(head, body, F.lit("\r\n\r\n")).cast("binary").alias("record"))


def leaves(written: DataFrame) -> DataFrame:
    """`file`, `key`, `copy` (its place among records of that key), `offset`, `length`, `hash` of a replica's records, by key in a file.
    Records without a key are spread by their hash over files of their own."""
    hashed = written.select("file", "key", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("hash"))
    file = F.when(F.col("file") >= 0, F.col("file")).otherwise(-1 - F.conv(F.substring("hash", 1, 7), 16, 10).cast("long"))
    hashed = hashed.withColumn("file", file)
    before = Window.partitionBy("file").orderBy("key", "hash").rowsBetween(Window.unboundedPreceding, -1)
    copy = F.row_number().over(Window.partitionBy("file", "key").orderBy("hash"))
    return hashed.withColumns({"offset": F.coalesce(F.sum("length").over(before), F.lit(0)), "copy": copy})


def _joined(*children: str) -> Column:
    """Hash of all the named columns of the children, in their order by the first of them."""
    text = lambda c: F.concat_ws(":", *[c[name].cast("string") for name in children])
    return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*children))), text), "/").cast("binary"), 256)


def tree(found: DataFrame, label: str) -> list[DataFrame]:
    """Records, ranges and files of a replica. Each level has `node`, `parent` and `hash`; nodes of the same name meet."""
    place = F.concat_ws("/", F.col("file").cast("string"), F.floor(F.col("offset") / RANGE_BYTES).cast("string"))
    base = found.withColumn("parent", place).withColumn("node", F.concat_ws("/", "file", F.coalesce(F.col("key").cast("string"), F.lit("-")), "copy"))
    levels = [stage(base, f"{label}-records")]
    ranges = levels[0].groupBy(F.col("parent").alias("node"), "file").agg(_joined("offset", "length", "hash").alias("hash"))
    ranges = ranges.select("node", F.col("file").cast("string").alias("parent"), F.substring_index("node", "/", -1).cast("long").alias("place"), "hash")
    levels.append(stage(ranges, f"{label}-ranges"))
    lower = levels[1].groupBy(F.col("parent").alias("node")).agg(_joined("place", "hash").alias("hash")).withColumn("place", F.col("node").cast("long"))
    return levels + [lower]


def upward(lower: DataFrame, depth: int, label: str) -> list[DataFrame]:
    """The levels from the files up to the root, `depth` of them above the files."""
    out = []
    for _ in range(depth + 1):
        up = F.floor(F.col("place") / FANOUT)
        own = stage(lower.select(F.col("place").cast("string").alias("node"), up.cast("string").alias("parent"), "place", "hash"), label)
        out.append(own)
        lower = own.groupBy(F.col("parent").cast("long").alias("place")).agg(_joined("place", "hash").alias("hash"))
    return out


def depth_of(*replicas: DataFrame) -> int:
    """Levels above the files until all share one root; files of records without a key (below 0) have a root of their own."""
    spans = [r.agg(F.min("place"), F.max("place")).first() for r in replicas]
    low, high = min((s[0] for s in spans if s[0] is not None), default=0), max((s[1] for s in spans if s[1] is not None), default=0)
    depth = 0
    while high // FANOUT**depth != low // FANOUT**depth and depth < 40:
        if low < 0 <= high and low // FANOUT**depth == -1 and high // FANOUT**depth == 0:
            break  # two roots, one for files without keys
        depth += 1
    return depth


def differing(mine: DataFrame, other: DataFrame, under: DataFrame | None, columns: list[str]) -> DataFrame:
    """Nodes whose hashes differ or that only one side has, among the children of `under` (all nodes, if none)."""
    if under is not None:
        mine, other = (x.join(under, x["parent"] == under["above"], "left_semi") for x in (mine, other))
    a = mine.select("node", F.struct("hash", *columns).alias("a"))
    b = other.select("node", F.struct("hash", *columns).alias("b"))
    return a.join(b, "node", "full").where("a IS NULL OR b IS NULL OR a != b")


def audit(mine: DataFrame, other: DataFrame) -> DataFrame:
    """Records (from `records`) of two replicas that differ: `file`, `key`, `copy`, `state` (changed, moved, missing: only
    in `mine`, extra: only in `other`), and of both sides `offset`, `length` and `hash`."""
    replicas = [tree(leaves(written), name) for name, written in (("mine", mine), ("other", other))]
    depth = depth_of(replicas[0][2], replicas[1][2])
    for r, name in zip(replicas, ("mine", "other")):
        r[2:] = upward(r[2], depth, f"{name}-files")
    under = None
    for a, b in zip(reversed(replicas[0][1:]), reversed(replicas[1][1:])):
        under = stage(differing(a, b, under, []).select(F.col("node").alias("above")), "differing")
    found = differing(replicas[0][0], replicas[1][0], under, ["file", "key", "copy", "offset", "length"])
    either = [F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in ("file", "key", "copy")]
    state = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(F.col("a.hash") == F.col("b.hash"), "moved")
    sides = [F.col(f"{side}.{c}").alias(f"{prefix}{c}") for side, prefix in (("a", ""), ("b", "other_")) for c in ("offset", "length", "hash")]
    return found.select(*either, state.otherwise("changed").alias("state"), *sides)
