"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A shingle's slot in a ring of 2^22 goes through one permutation; the second permutation,
shifted round the ring once for each coordinate, gives all coordinates: they stand side
by side in memory, so a signature is the minimum over slices of one array.

Documents with equal sets form a class and are compared once. Classes that share a band
become candidates in two rounds that lose no link and never form all pairs of a group:

1. in every band bucket, each class is checked against the one before it (the order
   differs from bucket to bucket), and links are joined to components;
2. in buckets that still hold several components, pairs across components are checked.

In the second round a pair must pass bounds on the set sizes (exact) and on the share of
equal coordinates in a wider signature, which only these classes get (missed with a
chance of 3 in a million at the similarity bound) before it is formed, in the first band
it shares and in no other. Links are confirmed on full sets of 64-bit shingle hashes.

Cases: a document without words (or null) has the empty set and links with nothing; one
with fewer words than a shingle has its whole sequence as one shingle; rows with a null
key link with nothing and are kept; rows that share a key are one node; an empty table
gives an empty result; only the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bourseline.llm.byte_bpe import sliced
from bourseline.llm.components import components
from bourseline.sources.storage import stage

RING = 1 << 22
BANDS, ROWS = 42, 6  # a pair at similarity 0.8 shares no band with a chance of 3 in a million
WIDE = 1024  # coordinates in the bound that comes before the sets
DEVIATIONS = 4.5
SIMILARITY = 80  # per cent
SEED = 20240229
SALTS = 16  # parts in which the classes of a component are met
PART = 1 << 21  # bytes hashed at a time
LONGEST = 64  # bytes of a word that is hashed as it is
WIDTH = 4096  # shingles whose coordinates are gathered at a time


@lru_cache(maxsize=1)
def _ring() -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and the second with its beginning once more at its end."""
    rng = np.random.default_rng(SEED)
    first = rng.permutation(RING).astype(np.uint32)
    second = rng.permutation(RING).astype(np.uint32)
    return first, np.concatenate([second, second[:WIDE]])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    base = 0x9E3779B97F4A7C15 | 1
    out = []
    for number in (base, pow(base, -1, 1 << 64)):
        steps = np.full(PART + 64 * (LONGEST + 1), number, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def _span_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of one part."""
    up, down = _powers()
    total = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum((np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)) * up[: len(text)], out=total[1:])
    return _mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles of `words` words."""
    own = text.lower().split()  # ASCII letters only, ASCII white space only
    if not own:
        return np.empty(0, dtype=np.uint64)
    words = min(words, len(own))
    lengths = np.fromiter(map(len, own), dtype=np.int64, count=len(own))
    for i in np.flatnonzero(lengths > LONGEST).tolist():  # long words stand in by a digest, so that parts stay small
        own[i] = b"\0" + hashlib.blake2b(own[i], digest_size=16).digest()
        lengths[i] = len(own[i])
    begins = np.cumsum(lengths + 1) - lengths - 1
    found, at, last = [], 0, len(own) - words + 1
    while at < last:
        stop = min(last, int(np.searchsorted(begins, begins[at] + PART)))
        part = b" ".join(own[at : stop + words - 1])
        starts, ends = begins[at:stop], begins[at + words - 1 : stop + words - 1] + lengths[at + words - 1 : stop + words - 1]
        found.append(_span_hashes(part, starts - begins[at], ends - begins[at]))
        at = stop
    return np.unique(np.concatenate(found))


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of coordinates for each set; sets must not be empty."""
    out = np.full((len(sets), coordinates), np.uint32(0xFFFFFFFF), dtype=np.uint32)
    if not sets:
        return out
    first, wrapped = _ring()
    slices = np.lib.stride_tricks.sliding_window_view(wrapped, coordinates)
    sizes = np.array([len(s) for s in sets])
    slots = first[(np.concatenate(sets) >> np.uint64(42)).astype(np.int64)]
    owner = np.repeat(np.arange(len(sets)), sizes)
    for at in range(0, len(slots), WIDTH):
        some, of = slots[at : at + WIDTH], owner[at : at + WIDTH]
        cuts = np.flatnonzero(np.diff(of, prepend=-1))
        least = np.minimum.reduceat(slices[some], cuts, axis=0)
        np.minimum(out[of[cuts]], least, out=least)
        out[of[cuts]] = least
    return out


def _bands(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
    keys = np.broadcast_to(keys, rows.shape[:2])
    for r in range(ROWS):
        keys = _mixed(keys ^ rows[:, :, r])
    return keys.view(np.int64)


def _planes(signature: np.ndarray) -> np.ndarray:
    """Two bits of each coordinate, 64 to a number: half of the numbers hold low bits, half the next."""
    planes = [np.packbits((signature >> np.uint32(k) & np.uint32(1)).astype(np.uint8), axis=1) for k in (0, 1)]
    return np.ascontiguousarray(np.concatenate(planes, axis=1)).view(np.int64)


def _set_id(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, words: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_shingles`, `set_id` and `bands` (null for the empty set), one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, 1):
                sets = [shingle_hashes(t or b"", words) for t in part.column(1).cast(pa.binary()).to_pylist()]
                some = [i for i, s in enumerate(sets) if len(s)]
                signed = signatures([sets[i] for i in some], BANDS * ROWS)
                ids: list[bytes | None] = [None] * len(sets)
                bands: list[np.ndarray | None] = [None] * len(sets)
                for i, b in zip(some, _bands(signed)):
                    ids[i], bands[i] = _set_id(sets[i]), b
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=[key, "n_shingles", "set_id", "bands"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_shingles long, set_id binary, bands array<long>")


def shingle_sets(docs: DataFrame, words: int, text: str = "text") -> DataFrame:
    """`set_id`, `shingles` (sorted little-endian 64-bit hashes) and `planes` (of `WIDE` coordinates) of each text that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, 0):
                sets = [shingle_hashes(t or b"", words) for t in part.column(0).cast(pa.binary()).to_pylist()]
                sets = [s for s in sets if len(s)]
                planes = pa.array(list(_planes(signatures(sets, WIDE))), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_set_id(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary()), planes],
                    names=["set_id", "shingles", "planes"],
                )

    return docs.select(text).mapInArrow(run, "set_id binary, shingles binary, planes array<long>")


def _near(n: str, other: str, planes: str, others: str, similarity: int):
    """Whether two sketches can belong to a link."""
    half = WIDE // 64
    unlike = lambda i: F.col(planes)[i].bitwiseXOR(F.col(others)[i])
    differ = sum((F.bit_count(unlike(i).bitwiseOR(unlike(i + half))) for i in range(half)), start=F.lit(0))
    sizes = 100 * F.least(n, other) >= similarity * F.greatest(n, other)
    # Two bits of unlike coordinates differ in three cases of four.
    share = 0.75 * (1 - similarity / 100)
    return sizes & (differ <= int(WIDE * share + DEVIATIONS * (WIDE * share * (1 - share)) ** 0.5))


def verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Those of the pairs (a, b) of set ids whose full sets reach the similarity."""
    full = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("s")), "a")
    full = full.join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("t")), "b").select("a", "b", "s", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for s, t in zip(batch.column(2), batch.column(3)):
                s, t = np.frombuffer(s.as_buffer(), dtype="<u8"), np.frombuffer(t.as_buffer(), dtype="<u8")
                both = len(s) + len(t) - len(np.union1d(s, t))
                kept.append(100 * both >= similarity * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return full.mapInArrow(run, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, similarity: int = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `key`, `n_shingles`, `component_id` (the smallest key reachable over links)
    and `kept` (the key is the component's). Links: 100 * shared shingles >= `similarity` * shingles of both."""
    docs = docs.select(key, text)
    known = stage(sketches(docs, words, key, text), "sketches")
    rows = known.where(F.col("set_id").isNotNull() & F.col(key).isNotNull())
    of_class = rows.groupBy("set_id").agg(F.min(key).alias("first"))
    classes = rows.join(of_class, "set_id").where(F.col(key) == F.col("first"))
    classes = stage(classes.select("set_id", "first", "n_shingles", "bands").dropDuplicates(["set_id"]), "classes")

    bucket = Window.partitionBy("band").orderBy(F.xxhash64("band", "set_id"), "set_id")
    buckets = classes.select("set_id", F.posexplode("bands").alias("place", "band"))
    buckets = buckets.select("band", "place", "set_id", F.lag("set_id").over(bucket).alias("before"), F.lead("set_id").over(bucket).alias("after"))
    buckets = stage(buckets.where("before IS NOT NULL OR after IS NOT NULL").drop("after"), "buckets")

    meeting = classes.join(buckets.select("set_id").distinct(), "set_id", "left_semi")
    needed = docs.join(meeting.select(F.col("first").alias(key)).distinct(), key, "left_semi")
    sets = stage(shingle_sets(needed, words, text).dropDuplicates(["set_id"]), "sets")
    meeting = meeting.select("set_id", "n_shingles", "bands").join(sets.select("set_id", "planes"), "set_id")

    ordered = [F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")]
    chain = buckets.where("before IS NOT NULL").select(F.col("set_id").alias("x"), F.col("before").alias("y"))
    chain = stage(chain.select(*ordered).distinct(), "pairs")
    several = rows.groupBy(key).agg(F.min("set_id").alias("a"), F.max("set_id").alias("z")).where("a != z")
    several = rows.join(several, key).select("a", F.col("set_id").alias("b"))
    links = stage(verified(chain, sets, similarity).unionByName(several), "links")

    so_far = components(links)
    whole = Window.partitionBy("band")
    still = (
        buckets.select("band", "place", "set_id").join(so_far, buckets["set_id"] == so_far["node"], "left")
        .select("band", "place", "set_id", F.coalesce("component", "set_id").alias("component"))
        .withColumn("lowest", F.min("component").over(whole)).withColumn("highest", F.max("component").over(whole))
        .where("lowest < highest").join(meeting, "set_id")
    )
    still = stage(still.select("band", "place", "set_id", "component", "lowest", "n_shingles", "planes", "bands"), "open")
    named = lambda df, *names: df.select("band", *[F.col(c).alias(n) for c, n in zip(("set_id", "component", "n_shingles", "planes", "bands", "place"), names)])
    left = named(still.where("component > lowest"), "x", "c", "n", "p", "e", "place")
    right = named(still, "y", "d", "m", "q", "f")
    first = F.forall(F.slice(F.arrays_zip("e", "f"), F.lit(1), F.col("place")), lambda z: z["e"] != z["f"])
    across = left.join(right, (left["band"] == right["band"]) & (F.col("c") > F.col("d")) & _near("n", "m", "p", "q", similarity) & first)
    across = across.select(*ordered).distinct().join(chain, ["a", "b"], "left_anti")
    more = verified(across, sets, similarity)

    # The links across components join these, and leave the links inside them alone.
    ends = [so_far.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in")) for c in ("a", "b")]
    between = more.join(ends[0], "a", "left").join(ends[1], "b", "left")
    merged = components(between.select(F.coalesce("a_in", "a").alias("a"), F.coalesce("b_in", "b").alias("b")))
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("merged"))
    linked = so_far.join(merged, "component", "left").select(F.col("node").alias("set_id"), F.coalesce("merged", "component").alias("component"))
    # Classes that only the second round has linked are components of their own so far.
    alone = merged.join(so_far, merged["component"] == so_far["node"], "left_anti").select(F.col("component").alias("set_id"), F.col("merged").alias("component"))
    linked = stage(linked.unionByName(alone).join(classes.select("set_id", "first"), "set_id"), "linked")
    # Classes, not rows, meet their component's smallest key, which is sent out several times: a large component is met in parts.
    salt = F.pmod(F.xxhash64("set_id"), F.lit(SALTS))
    least = linked.groupBy("component").agg(F.min("first").alias("least")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    joined = linked.withColumn("salt", salt).join(least, ["component", "salt"]).select("set_id", "least")
    of_set = classes.select("set_id", "first").join(joined, "set_id", "left").select("set_id", F.coalesce("least", "first").alias("component_id"))
    by_key = rows.select(key, "set_id").join(of_set, "set_id").groupBy(key).agg(F.min("component_id").alias("component_id"))
    out = known.select(key, "n_shingles").join(by_key, key, "left")
    found = F.coalesce("component_id", F.col(key))
    return out.select(key, "n_shingles", found.alias("component_id"), F.coalesce(F.col(key) == found, F.lit(True)).alias("kept"))
