"""Importance resampling against zlib and a plain version."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from bourseline.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LETTERS = "abZ09 .,é中\n_\x00`{\x7f\x80"


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(text, n):
    words = words_of(text)
    return [zlib.crc32(" ".join(words[j : j + n]).encode()) for j in range(len(words) - n + 1)]


def random_texts():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randrange(60))) for _ in range(300)]
    return [*texts, "", "a" * 3000 + " b" * 400, " ".join(f"w{rnd.randrange(999)}" for _ in range(30_000)), "x" * 70_000, "word"]


def test_crcs_of_n_grams_are_those_of_zlib():
    texts = random_texts()
    for n, (owner, crc, words) in enumerate(resampling.crcs([t.encode().lower() for t in texts], 1, 3), 1):
        assert list(zip(owner.tolist(), crc.tolist())) == [(i, c) for i, t in enumerate(texts) for c in grams(t, n)]
        assert words.tolist() == [len(words_of(t)) for t in texts]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_long_texts_in_parts(monkeypatch, n):
    monkeypatch.setattr(resampling, "PART", 1000)
    for text in [*random_texts()[-4:], "a b " * 3000, "é" * 1500 + "." + "b " * 999]:
        got, words = [], 0
        for some, known in resampling._in_parts(text.encode().lower(), n):
            ((_, crc, count),) = resampling._crcs(some, n, n, known)
            got += crc.tolist()
            words += count[0]
        assert got == grams(text, n) and words == len(words_of(text))


def plain(docs, target, percent, seed, least, high, buckets=10_000):
    raw, want = np.zeros(buckets), np.zeros(buckets)
    for table, into in ((docs, raw), (target, want)):
        for _, text in table:
            for n in range(1, high + 1):
                for c in grams(text, n):
                    into[c % buckets] += 1
    out = []
    for key, text in docs:
        own = [c % buckets for n in range(1, high + 1) for c in grams(text, n)]
        gains = [math.floor(1000 * math.log((want[b] + 1) * (raw.sum() + buckets) / ((raw[b] + 1) * (want.sum() + buckets)))) for b in own]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(words_of(text)), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = [*range(1, percent * len(able) // 100 + 1)]
    drawn = {}
    for r, rank in zip(able, ranks):
        drawn.setdefault(tuple(r), []).append(rank)
    return out, drawn, len(ranks)


@pytest.mark.parametrize("table", ["odd", "docs", "empty"])
@pytest.mark.parametrize("high", [1, 2])
def test_against_a_plain_version(spark, request, table, high):
    docs = request.getfixturevalue(table)
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = resampling.resample(docs, target, 30, 7, 5, high=high).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out, drawn, n = plain(rows, [(0, r["text"]) for r in target.collect()], 30, 7, 5, high)
    as_text = lambda rows: sorted(map(repr, rows))
    assert as_text([r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]] for r in got) == as_text(out)
    found = {}
    for r in got:
        if r["rank"] is not None:
            found.setdefault((r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]), []).append(r["rank"])
    assert {k: sorted(v) for k, v in found.items()} == drawn and sum(map(len, found.values())) == n


def test_repeated_rows_share_no_range(spark):
    """A third of all rows is one row: their ranks follow one another, and no range holds them all."""
    rows = [(1, "the same text " * 8)] * 400 + [(i, f"word{i} and others " * 9) for i in range(2, 802)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    got = resampling.resample(docs, docs.limit(0), 100, 3, 20).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 1201))
    own = sorted(r["rank"] for r in got if r["doc_id"] == 1)
    assert own[-1] - own[0] == 399
    assert [r["score"] for r in sorted(got, key=lambda r: r["rank"])] == sorted((r["score"] for r in got), reverse=True)


def test_drawn_documents_lean_towards_the_target(spark):
    rnd = random.Random(2)
    data = [(i, " ".join(rnd.choice(["near", "like", "target"] if i % 4 == 0 else ["far", "other", "raw"]) + str(rnd.randrange(30)) for _ in range(40))) for i in range(2000)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    target = spark.createDataFrame([(" ".join(f"{w}{k}" for w in ("near", "like", "target") for k in range(30)),)], "text string")
    got = resampling.resample(docs, target, 10, 11).where("rank IS NOT NULL").collect()
    assert len(got) == 200 and sum(r["doc_id"] % 4 == 0 for r in got) > 100  # 50 by chance
