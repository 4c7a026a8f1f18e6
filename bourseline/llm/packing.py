"""Packing documents into sequences: shortest pack first over the histogram of lengths.

1. `tokenize` turns each document into pieces of at most `size` ids.
2. `patterns` packs the histogram of piece lengths (at most `size` numbers, whatever the
   corpus holds): lengths are placed longest first, each into the pack that is shortest
   so far, and counts of equal packs move together as packing patterns.
3. `assign` ranks the pieces of each length and joins the ranks back to the patterns.

Ranks need no group in one task, and ids are never sent: each task numbers the pieces of a
length as it writes them, the counts by (length, task) are summed up over tasks, and each
stored row meets its own task's sums in a join on buckets by task.

Cases: a null text is an empty text; every document ends with the end id, so each has a
piece; null or repeated keys are rows like any other; an empty table gives no rows; only
the two named columns are read, so extra columns cannot clash; words are taken from
whole texts of any length.
"""

from __future__ import annotations

import heapq
import itertools
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bourseline.llm.byte_bpe import sliced
from bourseline.sources.storage import stage, stage_buckets

SIZE = 2048
END_ID = 1
CACHED = 250_000  # words of a generation
LONGEST_CACHED = 64  # bytes
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class Words:
    """Ids of words, kept in two generations: words met again move to the young one, and when
    that is full, the old one goes."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. The tokenizer drops white
        space and never joins across it, so words are encoded one by one."""
        if len(self.young) > CACHED:
            self.old, self.young = self.young, {}
        known, old = self.young, self.old
        out, gaps = [], []
        new: dict[bytes, bytes] = {}

        def ids_of(word: bytes) -> bytes | None:
            """What is known of a word; it is noted as new otherwise."""
            ids = known.get(word) or old.get(word)
            if ids is None:
                new.setdefault(word, b"")
            else:
                known[word] = ids
            return ids

        for text in texts:
            # ASCII white space only, any other is left to the tokenizer; it lowers letters, so ASCII ones may be lowered first.
            words = text.lower().split()
            found = list(map(known.get, words))
            at = -1
            for _ in range(found.count(None)):
                at = found.index(None, at + 1)
                word = words[at]
                found[at] = old.get(word)
                if found[at] is None:
                    cut = len(word) - len(_tail(word))
                    head, tail = ids_of(word[:cut]), ids_of(word[cut:]) if cut < len(word) else b""
                    if head is None or tail is None:
                        gaps.append((found, at, word, cut))
                    else:
                        found[at] = known[word] = head + tail
                else:
                    known[word] = found[at]
            out.append(found)
        fresh = list(new)
        for at in range(0, len(fresh), 4096):
            some = fresh[at : at + 4096]
            encoded = self.tokenizer.encode_batch([w.decode("utf-8", "surrogatepass") for w in some], add_special_tokens=False)
            for word, encoding in zip(some, encoded):
                new[word] = array("I", encoding.ids).tobytes()
        for found, at, word, cut in gaps:
            parts = [x for x in (word[:cut], word[cut:]) if x]
            ids = b"".join([new[x] if x in new else known[x] for x in parts])
            found[at] = ids
            if len(word) <= LONGEST_CACHED:
                known[word] = ids
        known.update((w, i) for w, i in new.items() if len(w) <= LONGEST_CACHED)
        return [b"".join(found) for found in out]


def _tail(word: bytes) -> bytes:
    """The ASCII punctuation at a word's end, if a letter or an ASCII figure stands before it and is still the last character
    there once the tokenizer has composed and lowered it (some end in a mark then). There the tokenizer always
    begins a new piece, and no piece of letters or figures reaches over it, so both parts have ids of their own."""
    head = word.rstrip(PUNCTUATION)
    if not head or len(head) == len(word):
        return b""
    last = head[-1]
    if last < 0x80:
        return word[len(head) :] if head[-1:].isalnum() else b""
    return word[len(head) :] if _ends_in_letter(head.decode("utf-8", "surrogatepass")[-1]) else b""


@lru_cache(maxsize=4096)
def _ends_in_letter(character: str) -> bool:
    return character.isalpha() and unicodedata.normalize("NFC", character).lower()[-1].isalpha()


@lru_cache(maxsize=1)
def _words(path: str) -> Words:
    return Words(path)


class Numbers:
    """Numbers of the pieces of each length, as a task meets them."""

    def __init__(self) -> None:
        self.part = TaskContext.get().partitionId()
        self.so_far: dict[int, int] = {}

    def columns(self, lengths: np.ndarray) -> list[pa.Array]:
        """`_pack_part`, the task, and `_pack_in`, how many pieces of the length came before in it."""
        own = np.empty(len(lengths), dtype=np.int64)
        order = np.argsort(lengths, kind="stable")
        kinds, begins, counts = np.unique(lengths[order], return_index=True, return_counts=True)
        for length, begin, count in zip(kinds.tolist(), begins.tolist(), counts.tolist()):
            before = self.so_far.get(length, 0)
            own[order[begin : begin + count]] = np.arange(before, before + count)
            self.so_far[length] = before + count
        return [pa.array(np.full(len(own), self.part, dtype=np.int64)), pa.array(own)]


NUMBERED = ["_pack_part", "_pack_in"]


def tokenize(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID, key: str = "doc_id", text: str = "text", numbered: bool = False) -> DataFrame:
    """Pieces of the documents: `key`, `start` (ids of the document before the piece), `length`,
    `ids` (little-endian unsigned 32-bit) and `doc_tokens` (ids of the document with its end id); with `numbered` also
    the numbers that `assign` needs, which it would else take in a pass of its own."""
    end = np.array([end_id], dtype="<u4").tobytes()
    more = NUMBERED if numbered else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        numbers = Numbers()
        for batch in batches:
            for part in sliced(batch, 1):
                rows, starts, ids, totals = [], [], [], []
                texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
                for row, own in enumerate(words.ids(texts)):
                    own += end
                    for at in range(0, len(own), 4 * size):
                        rows.append(row)
                        starts.append(at // 4)
                        ids.append(own[at : at + 4 * size])
                        totals.append(len(own) // 4)
                lengths = np.array([len(i) // 4 for i in ids], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths),
                        pa.array(ids, pa.binary()),
                        pa.array(totals, pa.int64()),
                        *(numbers.columns(lengths) if numbered else []),
                    ],
                    names=[key, "start", "length", "ids", "doc_tokens", *more],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long" + "".join(f", {c} long" for c in more))


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, list[tuple[int, int]]]]:
    """(how many sequences, [(length, how often in the sequence), ...]) for each pattern.

    Packs wait in a heap by the room they have used. A length goes to the shortest pack; if
    that has no room, new packs begin. Equal packs move at once, and a pack takes the same
    length again while it stays the shortest, so the steps follow the number of patterns.
    """
    heap: list[tuple[int, int, int, tuple]] = []  # used, serial number, how many, content as a chain
    serial = itertools.count()
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not heap or heap[0][0] + length > size:
                # A new pack is the shortest there is, and so takes the same length until it is full.
                times = size // length
                for count, copies in ((left // times, times), (1, left % times)):
                    if count and copies:
                        heapq.heappush(heap, (length * copies, next(serial), count, ((length, copies), None)))
                break
            used, _, count, chain = heapq.heappop(heap)
            if count > left:
                heapq.heappush(heap, (used, next(serial), count - left, chain))
                count = left
            room = (size - used) // length
            until = heap[0][0] - used if heap else size
            times = max(1, min(room, left // count, until // length))
            left -= count * times
            if chain[0][0] == length:
                chain = ((length, chain[0][1] + times), chain[1])
            else:
                chain = ((length, times), chain)
            heapq.heappush(heap, (used + length * times, next(serial), count, chain))
    out = []
    for _, _, count, chain in sorted(heap, key=lambda x: x[1]):
        content = []
        while chain:
            content.append(chain[0])
            chain = chain[1]
        out.append((count, content[::-1]))
    return out


def _slots(found: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """For each length the rows (first rank, copies in a sequence, first sequence, offset), by rank."""
    ranks: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for count, content in found:
        offset = 0
        for length, copies in content:
            at = ranks.get(length, 0)
            rows.setdefault(length, []).append((at, copies, sequence, offset))
            ranks[length] = at + count * copies
            offset += length * copies
        sequence += count
    return {length: np.array(r, dtype=np.int64) for length, r in rows.items()}


def _numbered(pieces: DataFrame) -> DataFrame:
    """`pieces` with `_pack_part` and `_pack_in`."""
    names = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        for batch in batches:
            lengths = np.asarray(batch.column(names.index("length")))
            yield pa.RecordBatch.from_arrays([*batch.columns, *numbers.columns(lengths)], names=[*names, *NUMBERED])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return pieces.mapInArrow(run, schema + ", _pack_part long, _pack_in long")


def assign(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`. The rows are stored once, in buckets by the task that wrote them, so that their
    ranks stay the same when tasks run again, and meet their task's offsets without being sent anywhere. Uses the column
    `length`; names that begin with `_pack_` are reserved. Numbered pieces must all be there."""
    names = [c for c in pieces.columns if c not in NUMBERED]
    stored = stage_buckets(pieces if set(NUMBERED) <= set(pieces.columns) else _numbered(pieces), "pieces", "_pack_part")
    counted = stage(stored.groupBy("length", "_pack_part").agg(F.count("*").alias("_pack_n"), F.max("_pack_in").alias("_pack_last")), "lengths")
    if not counted.where("_pack_n != _pack_last + 1").isEmpty():
        raise ValueError("pieces were numbered, and then some left out or repeated")
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("_pack_n").alias("n")).collect()}  # at most `size` rows
    slots = _slots(patterns(histogram, size))

    # For each task the ranks that its first pieces of every length have; a length has one row for each task.
    before = Window.partitionBy("length").orderBy("_pack_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counted.withColumn("_pack_before", F.coalesce(F.sum("_pack_n").over(before), F.lit(0)))
    of_part = firsts.groupBy("_pack_part").agg(F.map_from_entries(F.collect_list(F.struct("length", "_pack_before"))).alias("m"))
    of_part = of_part.select("_pack_part", F.transform(F.sequence(F.lit(0), F.lit(size)), lambda i: F.element_at("m", i.cast("long"))).alias("_pack_firsts"))
    of_part = stage(of_part, "firsts")
    rank = F.get("_pack_firsts", F.col("length").cast("int")) + F.col("_pack_in")
    ranked = stored.join(of_part.hint("shuffle_hash"), "_pack_part").select(*[F.col(f"`{c}`") for c in names], rank.alias("_pack_rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch.column(batch.schema.get_field_index("length")))
            rank = np.asarray(batch.column(batch.num_columns - 1))
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                table = slots[length]
                line = table[np.searchsorted(table[:, 0], rank[rows], side="right") - 1]
                k = rank[rows] - line[:, 0]
                sequence[rows] = line[:, 2] + k // line[:, 1]
                offset[rows] = line[:, 3] + (k % line[:, 1]) * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields[:-1])
    return ranked.mapInArrow(run, schema + ", sequence_id long, offset long")
