"""Near-duplicates against all pairs, and components against a plain search."""

import random
import re

import numpy as np
import pytest

from bourseline.llm import minhash
from bourseline.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, words, similarity=80):
    """{key: (sizes, smallest reachable key)} by comparing every pair."""
    lower = {c: c + 32 for c in range(65, 91)}
    sets = []
    for key, text in rows:
        own = WORD.findall((text or "").translate(lower))
        sets.append((key, frozenset(tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))) if own else frozenset()))
    root = {k: k for k, _ in sets if k is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and a is not None and b is not None and 100 * len(s & t) >= similarity * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted(((k if k is not None else -1), len(s), find(k) if k is not None else -1) for k, s in sets)


def found(df):
    rows = df.collect()
    for r in rows:
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_shingles"], r["component_id"] if r["component_id"] is not None else -1) for r in rows)


@pytest.mark.parametrize("table", ["odd", "empty", "docs"])
@pytest.mark.parametrize("words", [4, 5])
def test_tables(table, words, request):
    docs = request.getfixturevalue(table)
    assert found(minhash.near_duplicates(docs, words)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], words)


def test_copies_of_many_degrees(spark):
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([8, 40, 150]))]
        for _ in range(25):
            own = [w if rnd.random() > 0.02 else rnd.choice(vocabulary) for w in base]
            rows.append((len(rows), " ".join(own)))
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found(minhash.near_duplicates(docs, 4)) == brute(rows, 4)


def test_a_key_with_two_texts_joins_their_groups(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = spark.createDataFrame([(5, a), (3, a), (5, b), (9, b)], "doc_id bigint, text string")
    assert {(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()} == {(3, 3), (5, 3), (9, 3)}


def test_long_words_and_parts(monkeypatch):
    text = (" ".join(f"word{i}" for i in range(500)) + " " + "y" * 300 + " end of it").encode()
    whole = minhash.shingle_hashes(text, 4)
    monkeypatch.setattr(minhash, "PART", 100)
    assert np.array_equal(minhash.shingle_hashes(text, 4), whole) and len(whole) == 501


def test_share_of_equal_coordinates_estimates_the_similarity():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = minhash.signatures([np.unique(x[:2500]), np.unique(x[500:])], 512)
    assert abs((a == b).mean() - 2000 / 3000) < 0.1


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 201), (200, 201)]
    rnd.shuffle(edges)
    rows = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["component"], set()).add(r["node"])
    assert sorted(map(sorted, groups.values())) == [list(range(20)), list(range(20, 40)), list(range(40, 60)), list(range(100, 140)), [200, 201]]
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
