"""Quality classifier: a byte-level convolutional network in numpy.

`FILTERS` learned filters of `TAPS` bytes run over every byte of a text. Each filter's
largest response is taken in blocks of `STRIDE` bytes; two neighbouring blocks make a
chunk, so chunks overlap by half and cover the whole text. The pooled responses of a
chunk give its logit, and the mean logit of all chunks one probability per document.

The fit takes at most `FIT_ROWS` labelled documents of each label, those with the lowest hashes of
their ids, whatever their length; of a text above `FIT_BYTES` bytes it takes `EXCERPTS` pieces of as many bytes in all, spread
evenly over the whole of it. Scoring reads every byte of every text.
The bias is shifted to the share of the labels among all labelled rows given.

Cases: a null text is an empty text, which is scored by the bias alone; rows may repeat;
null keys stay; of an id with several texts the fit takes the one with the lowest hash, and an id
with both labels has none; without labels of both kinds every score is one half; an empty table gives
an empty result; only the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourseline.llm.byte_bpe import sliced

TAPS, FILTERS, STRIDE = 8, 16, 128
FIT_ROWS, FIT_BYTES, EXCERPTS = 400, 32_768, 8
EPOCHS, BATCH, RATE, SEED = 12, 32, 0.02, 7
PART = 1 << 16  # bytes whose responses are held at a time
NOWHERE = np.float32(-1e30)


@dataclass
class Network:
    filters: np.ndarray  # taps x 256 x filters
    bias: np.ndarray
    weights: np.ndarray
    shift: float


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in one array, each from a multiple of the stride on and with room for the last taps:
    (bytes, which positions hold a text, the first block of each text)."""
    blocks = np.array([max(1, -(-(len(t) + TAPS - 1) // STRIDE)) for t in texts])
    begins = np.cumsum(blocks) - blocks
    codes = np.zeros(int(blocks.sum()) * STRIDE + TAPS, dtype=np.uint8)
    held = np.zeros(len(codes) - TAPS, dtype=bool)
    for t, b in zip(texts, (begins * STRIDE).tolist()):
        codes[b : b + len(t)] = np.frombuffer(t, dtype=np.uint8)
        held[b : b + len(t)] = True
    return codes, held, begins


def _chunks(blocks: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each chunk its two blocks; the last block of a text is alone if the text has no other."""
    first = np.arange(len(blocks))
    ends = np.append(begins[1:], len(blocks))
    second = first + 1
    second[ends - 1] = ends - 1
    alone = ends - begins == 1
    keep = np.ones(len(blocks), dtype=bool)
    keep[(ends - 1)[~alone]] = False
    return first[keep], second[keep]


def fit(texts: list[bytes], labels: np.ndarray, share: float) -> Network:
    """Train by Adam on the logistic loss of the documents' mean chunk logits."""
    rng = np.random.default_rng(SEED)
    p = [
        rng.normal(0, 0.15, (TAPS, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, dtype=np.float32),
        rng.normal(0, 0.3, FILTERS).astype(np.float32), np.zeros(1, dtype=np.float32),
    ]
    means, squares = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            codes, held, begins = _laid_out([texts[i] for i in rows])
            n = len(held)
            out = p[0][0][codes[:n]]
            for t in range(1, TAPS):
                out += p[0][t][codes[t : t + n]]
            out[~held] = NOWHERE
            out = out.reshape(-1, STRIDE, FILTERS)
            where = out.argmax(1)
            blocks = np.take_along_axis(out, where[:, None, :], 1)[:, 0] + p[1]
            a, b = _chunks(blocks, begins)
            second = blocks[b] > blocks[a]
            pooled = np.maximum(np.where(second, blocks[b], blocks[a]), 0)
            logits = pooled @ p[2] + p[3]
            owner = np.searchsorted(begins, a, side="right") - 1
            counts = np.bincount(owner, minlength=len(rows))
            mean = np.bincount(owner, logits, len(rows)) / counts
            slope = (1 / (1 + np.exp(-np.clip(mean, -30, 30))) - labels[rows]) / len(rows)
            by_chunk = (slope / counts)[owner].astype(np.float32)
            grads = [None, None, pooled.T @ by_chunk, np.array([by_chunk.sum()], dtype=np.float32)]
            back = by_chunk[:, None] * p[2] * (pooled > 0)
            to_block = np.zeros_like(blocks)
            chosen = np.where(second, b[:, None], a[:, None])
            np.add.at(to_block, (chosen, np.arange(FILTERS)[None, :]), back)
            grads[1] = to_block.sum(0)
            i, f = np.nonzero(to_block)
            at_byte, g = i * STRIDE + where[i, f], to_block[i, f]
            grads[0] = np.stack([np.bincount(codes[at_byte + t].astype(np.int64) * FILTERS + f, g, 256 * FILTERS) for t in range(TAPS)]).reshape(TAPS, 256, FILTERS)
            step += 1
            for x, gx, m, s in zip(p, grads, means, squares):
                m += 0.1 * (gx - m)
                s += 0.01 * (gx * gx - s)
                x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    own = float(np.mean(labels))
    prior = math.log(share / (1 - share)) - math.log(own / (1 - own))
    return Network(p[0], p[1], p[2], float(p[3][0]) + prior)


class Scorer:
    def __init__(self, network: Network) -> None:
        self.network = network
        w = network.filters
        # Responses of two bytes at once, by the number that the two make.
        self.pairs = [np.ascontiguousarray((w[t][:, None, :] + w[t + 1][None, :, :]).reshape(65536, FILTERS)) for t in range(0, TAPS, 2)]

    def blocks(self, codes: np.ndarray, held: np.ndarray) -> np.ndarray:
        """The largest response of each filter in each block."""
        out = np.empty((len(held) // STRIDE, FILTERS), dtype=np.float32)
        for at in range(0, len(held), PART):
            n = min(PART, len(held) - at)
            part = codes[at : at + n + TAPS].astype(np.int64)
            twos = (part[:-1] << 8) | part[1:]
            response = self.pairs[0][twos[:n]]
            for j in range(1, TAPS // 2):
                response += self.pairs[j][twos[2 * j : 2 * j + n]]
            response[~held[at : at + n]] = NOWHERE
            out[at // STRIDE : (at + n) // STRIDE] = response.reshape(-1, STRIDE, FILTERS).max(1)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        codes, held, begins = _laid_out(texts)
        blocks = self.blocks(codes, held) + self.network.bias
        a, b = _chunks(blocks, begins)
        logits = np.maximum(np.maximum(blocks[a], blocks[b]), 0).astype(np.float64) @ self.network.weights.astype(np.float64)
        owner = np.searchsorted(begins, a, side="right") - 1
        mean = np.bincount(owner, logits, len(texts)) / np.bincount(owner, minlength=len(texts)) + self.network.shift
        return 1 / (1 + np.exp(-np.clip(mean, -500, 500)))


def excerpt(text: str, most: int = FIT_BYTES, pieces: int = EXCERPTS) -> Column:
    """The bytes of a text, or of a longer one `pieces` of `most` bytes in all, spread evenly from its beginning to its end."""
    raw, size = F.coalesce(F.col(text), F.lit("")).cast("binary"), F.octet_length(F.coalesce(F.col(text), F.lit("")))
    part = most // pieces
    begins = [F.floor((size - part) * k / (pieces - 1)).cast("int") + 1 for k in range(pieces)]
    return F.when(size <= most, raw).otherwise(F.concat(*[F.substring(raw, b, F.lit(part)) for b in begins]))


def sampled(docs: DataFrame, chosen: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """`h` (hash of the key), `t` (excerpt) and `y`, one row for each chosen key that has a document: the one whose text has the lowest
    hash. The chosen keys are few and are sent to the documents."""
    found = docs.select(key, text).join(F.broadcast(chosen), key)
    first = found.groupBy(key, label).agg(F.min(F.struct(F.xxhash64(text).alias("of"), excerpt(text).alias("t"))).alias("first"))
    return first.select(F.xxhash64(key).alias("h"), F.col("first")["t"].alias("t"), F.col(label).alias("y"))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = FIT_ROWS) -> Network | None:
    """A network from at most `rows` labelled documents of each label, those with the lowest hashes of their keys."""
    own = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias(label), F.max(label).alias("_other"))
    own = own.where(F.col(label) == F.col("_other")).select(key, label)
    counts = {r[label]: r["n"] for r in own.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    known = docs.select(key).where(F.col(key).isNotNull()).distinct()  # a label may have no document
    some = [own.where(F.col(label) == y).join(known, key, "left_semi").orderBy(F.xxhash64(key), key).limit(rows) for y in (0, 1)]
    chosen = some[0].unionByName(some[1])
    data = sampled(docs, chosen, key, text, label).orderBy("y", "h", "t").collect()  # at most twice `rows`, of FIT_BYTES each
    if len({r["y"] for r in data}) < 2:
        return None
    return fit([bytes(r["t"]) for r in data], np.array([r["y"] for r in data], dtype=np.float64), counts[1] / (counts[0] + counts[1]))


def score(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and `score`, the probability of label 1, one row per row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(network) if network else None
        for batch in batches:
            for part in sliced(batch, 1):
                texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
                scores = scorer.score(texts) if scorer else np.full(len(texts), 0.5)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=[key, "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double")
