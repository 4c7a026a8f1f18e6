"""Resampling documents towards a target distribution, with n-gram buckets from prefix CRCs.

1. A text becomes its words (ASCII letters and figures, letters lowered, and everything beyond
   ASCII) joined by single blanks, and is scanned once. Running CRCs are kept where words begin
   and end: the bytes of a block, each moved to the block's end by multiplication in GF(2)[x],
   add up by exclusive or, so a block is one table look-up and one accumulation.
2. The CRC of any n-gram is the running CRC at its end, plus the one at its beginning moved by
   the n-gram's length: what came before cancels.
3. Counts by bucket (the CRC modulo `buckets`) of the target and of all documents give each
   bucket a gain; a document's weight is the mean gain of its n-grams, and a score adds Gumbel
   noise that depends on the document's id alone, so the highest scores are a sample without
   replacement by importance.
4. Ranks come from one exchange by ranges of the score; the row's place in the table is the last
   sort key, so neither equal scores nor repeated rows can gather in one range.

Cases: a null or empty text, and one without words, has no features, weight 0 and no rank; rows with
null or repeated ids are rows like any other (a null id's noise is that of an empty id, and null ids
come last among equal scores); an empty table gives an empty result, an empty target a target
without counts; only the named columns are read, so extra columns cannot clash; texts of any length
are scanned as a whole, in parts that overlap by what an n-gram needs. A part ends at a separator, so
memory follows the longest word of a text above 1 MiB, not the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourseline.llm.byte_bpe import sliced
from bourseline.sources.storage import stage

POLYNOMIAL = 0xEDB88320  # CRC-32, bits reversed
ONES = np.uint32(0xFFFFFFFF)
BLOCK = 256  # bytes
PART = 1 << 20  # bytes of a long text scanned at a time
SEPARATOR = re.compile(rb"[^0-9a-z\x80-\xff]")
IN_WORD = np.array([SEPARATOR.match(bytes([b])) is None for b in range(256)])


def _step(register: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[register & np.uint32(255)] ^ (register >> np.uint32(8))


def _moved(tables: np.ndarray, register: np.ndarray, at: np.ndarray | int) -> np.ndarray:
    """`register` under the linear map number `at`, given as four tables of 256 entries each."""
    flat = tables.reshape(-1)
    first = np.asarray(at, dtype=np.int64) * 1024
    out = flat[first + (register & np.uint32(255))]
    for k in (1, 2, 3):
        out = out ^ flat[first + 256 * k + ((register >> np.uint32(8 * k)) & np.uint32(255))]
    return out


class Shifts:
    """Multiplication of registers by powers of x, as table look-ups."""

    def __init__(self) -> None:
        byte = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            byte = np.where(byte & np.uint32(1), (byte >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), byte >> np.uint32(1))
        self.byte = byte
        whole = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
        top = np.empty(256, dtype=np.uint32)
        top[byte >> np.uint32(24)] = np.arange(256, dtype=np.uint32)
        on, back = [whole], [whole]
        for _ in range(BLOCK):
            on.append(_step(on[-1], byte))
            index = top[back[-1] >> np.uint32(24)]
            back.append(((back[-1] ^ byte[index]) << np.uint32(8)) | index)
        self.on, self.back = np.stack(on), np.stack(back)  # by 0 to BLOCK bytes, forward and backward
        # What a byte at place i of a block adds to the register at the block's end.
        self.in_block = np.stack([_moved(self.on, byte, BLOCK - 1 - i) for i in range(BLOCK)])

    def by(self, register: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """Registers after so many zero bytes."""
        out = _moved(self.on, register, bytes_ % BLOCK)
        rest, double = bytes_ // BLOCK, self.on[BLOCK]
        while rest.any():
            odd = (rest & 1).astype(bool)
            out[odd] = _moved(double[None], out[odd], 0)
            rest, double = rest >> 1, _moved(double[None], double, 0)
        return out


@lru_cache(maxsize=1)
def _shifts() -> Shifts:
    return Shifts()


def running(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The register (begun at zero) after the first `places` bytes of `text`; `places` rise."""
    shifts = _shifts()
    out = np.zeros(len(places), dtype=np.uint32)
    carry = 0
    on = [t.tolist() for t in shifts.on[BLOCK]]
    many = BLOCK * 256  # bytes whose registers are held at a time
    for at in range(0, len(text), many):
        part = text[at : at + many]
        blocks = -(-len(part) // BLOCK)
        padded = np.zeros(blocks * BLOCK, dtype=np.uint8)
        padded[: len(part)] = part
        held = np.zeros((blocks, BLOCK + 1), dtype=np.uint32)
        np.bitwise_xor.accumulate(shifts.in_block[np.arange(BLOCK), padded.reshape(blocks, BLOCK)], axis=1, out=held[:, 1:])
        carries = []
        for total in held[:, -1].tolist():
            carries.append(carry)
            carry = on[0][carry & 255] ^ on[1][carry >> 8 & 255] ^ on[2][carry >> 16 & 255] ^ on[3][carry >> 24] ^ total
        low, high = np.searchsorted(places, [at + 1, at + many + 1])
        block, inside = np.divmod(places[low:high] - 1 - at, BLOCK)
        inside += 1
        own = _moved(shifts.back, held[block, inside], BLOCK - inside)
        out[low:high] = own ^ _moved(shifts.on, np.array(carries, dtype=np.uint32)[block], inside)
    return out


def _normalised(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of the words with a blank after each, where words begin there, their lengths, where they begin in `text`)."""
    raw = np.frombuffer(text, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = IN_WORD[raw]
    begins = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    lengths = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1 - begins
    joined = np.where(inside[1:-1], raw, np.uint8(32))[inside[1:-1] | inside[:-2]]
    if len(begins) and begins[-1] + lengths[-1] == len(raw):
        joined = np.append(joined, np.uint8(32))
    return joined, np.cumsum(lengths + 1) - lengths - 1, lengths, begins


def crcs(texts: list[bytes], low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For n from `low` to `high`: (which text, CRC) of each n-gram, and the number of words of each text.
    The texts have lower-case letters."""
    yield from _crcs(texts, low, high, 0)


def _crcs(texts: list[bytes], low: int, high: int, known: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """As `crcs`; n-grams that end in the first `known` words are left out, and these are not counted."""
    joined, starts, lengths, begins = _normalised(b"\n".join(texts))
    ends = starts + lengths
    until = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(until, begins, side="right")
    words = np.bincount(owner[known:], minlength=len(texts))
    places = np.empty(2 * len(starts), dtype=np.int64)
    places[::2], places[1::2] = starts, ends
    registers = running(joined, places)
    before, after = registers[::2], registers[1::2]
    for n in range(low, high + 1):
        first = np.arange(max(0, known - n + 1), max(0, len(starts) - n + 1))
        first = first[owner[first] == owner[first + n - 1]]
        last = first + n - 1
        size = ends[last] - starts[first]
        yield owner[first], after[last] ^ _shifts().by(before[first] ^ ONES, size) ^ ONES, words


def _in_parts(text: bytes, high: int) -> Iterator[tuple[list[bytes], int]]:
    """A long text as ([part], how many words at its beginning are the last ones of the part before)."""
    at, head, known = 0, b"", 0
    while at < len(text):
        cut = SEPARATOR.search(text, min(len(text), at + PART))
        stop = cut.start() if cut else len(text)
        part = head + b" " + text[at:stop]
        yield [part], known
        joined, starts, _, _ = _normalised(part)
        known = min(high - 1, len(starts))
        head = joined[starts[-known] :].tobytes() if known else b""
        at = stop


def features(batch: pa.RecordBatch, column: int, low: int, high: int, buckets: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """For parts of the batch: (rows, which row each n-gram belongs to, its bucket, words of each row).
    A row with a long text comes in several parts."""
    for part in sliced(batch, column):
        texts = [(t or b"").lower() for t in part.column(column).cast(pa.binary()).to_pylist()]
        pieces = _in_parts(texts[0], high) if len(texts) == 1 and len(texts[0]) > PART else [(texts, 0)]
        for some, known in pieces:
            found = list(_crcs(some, low, high, known))
            owner = np.concatenate([f[0] for f in found])
            yield part, owner, np.concatenate([f[1] for f in found]).astype(np.int64) % buckets, found[0][2]


def counts(docs: DataFrame, text: str = "text", low: int = 1, high: int = 1, buckets: int = 10_000) -> DataFrame:
    """`bucket` and `n`, how many n-grams of all texts fall into it; buckets without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, bucket, _ in features(batch, 0, low, high, buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])

    return docs.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", low: int = 1, high: int = 1, buckets: int = 10_000) -> np.ndarray:
    """For each bucket 1000 times the logarithm of its target probability over its raw one, rounded down."""
    raw = counts(docs, text, low, high, buckets).withColumnRenamed("n", "s")
    wanted = counts(target, text, low, high, buckets).withColumnRenamed("n", "t")
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(raw, "bucket", "left").join(wanted, "bucket", "left").na.fill(0)
    every = stage(every.select("bucket", F.col("s").cast("double").alias("s"), F.col("t").cast("double").alias("t")), "buckets")
    both = every.groupBy().agg(F.sum("s").alias("S"), F.sum("t").alias("T"))
    n_raw, n_target = both.select("S").scalar(), both.select("T").scalar()
    ratio = (F.col("t") + 1) * (n_raw + buckets) / ((F.col("s") + 1) * (n_target + buckets))
    rows = every.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).collect()  # `buckets` rows
    out = np.zeros(buckets, dtype=np.int64)
    out[[r["bucket"] for r in rows]] = [r["gain"] for r in rows]
    return out


def weigh(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", low: int = 1, high: int = 1) -> DataFrame:
    """`key`, `n_words`, `n_features` and `weight` (the mean gain, rounded down), one row per row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(part: pa.RecordBatch, words: np.ndarray, n: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
            weight = np.floor_divide(total, np.maximum(n, 1))
            return pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (words, n, weight))], names=[key, "n_words", "n_features", "weight"])

        for batch in batches:
            last = None
            for part, owner, bucket, words in features(batch, 1, low, high, len(gain)):
                n = np.bincount(owner, minlength=part.num_rows)
                total = np.bincount(owner, gain[bucket], part.num_rows).astype(np.int64)
                if last is not None and last[0] is part:
                    last = (part, last[1] + words, last[2] + n, last[3] + total)
                    continue
                if last is not None:
                    yield row(*last)
                last = (part, words, n, total)
            if last is not None:
                yield row(*last)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_words long, n_features long, weight long")


def noise(key: str | Column, seed: int) -> Column:
    """1000 times a Gumbel variate that depends on the key and the seed alone, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string") if isinstance(key, str) else key, F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def draw(weighed: DataFrame, percent: int, seed: int, least_words: int = 20, key: str = "doc_id") -> DataFrame:
    """`weighed` with `score` (weight and noise) and `rank`: 1, 2, 3, ... by falling score, ties by rising key, for the
    first `percent` per cent (rounded down) of the rows with at least `least_words` words; null for all others."""
    rows = weighed.withColumn("score", F.col("weight") + noise(key, seed)).withColumn("_able", F.col("n_words") >= least_words)
    rows = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "scored")
    order = [F.col("_able").desc(), F.col("score").desc(), F.col(key).asc_nulls_last(), F.col("_row").asc()]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id holds the partition in its upper bits and the place within it in its lower 33.
    placed = stage(placed.withColumn("_place", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_place", 33)), "placed")
    parts = placed.groupBy("_part").agg(F.count("*").alias("n"), F.count_if("_able").alias("able"))  # one row per range
    before = parts.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    drawn = parts.select(F.floor(F.sum("able") * percent / 100).alias("k")).scalar()
    rank = F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    ranked = placed.join(before, "_part").withColumn("rank", rank)
    return ranked.select(*weighed.columns, "score", F.when(F.col("_able") & (F.col("rank") <= drawn), F.col("rank")).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, percent: int, seed: int, least_words: int = 20,
    key: str = "doc_id", text: str = "text", low: int = 1, high: int = 1, buckets: int = 10_000,
) -> DataFrame:
    """One row per row of `docs`: `key`, `n_words`, `n_features`, `weight`, `score` and `rank`."""
    gain = gains(docs, target, text, low, high, buckets)
    return draw(weigh(docs, gain, key, text, low, high), percent, seed, least_words, key)
