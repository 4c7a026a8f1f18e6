"""Toxicity: the composed grammar against its parts, clauses by example, and held-out accuracy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bourseline.llm import toxicity

MODEL = toxicity.Model({"blarg": toxicity.INSULT[3], "meh": toxicity.INSULT[0]})


def found(text, model=MODEL):
    return [(text[a:b], round(w, 6)) for a, b, w in toxicity.clauses(text, model.lexicon())]


def test_composed_machine_is_the_chain_of_its_parts():
    rnd = random.Random(1)
    parts = [toxicity.negation(), toxicity.reported(), toxicity.targeted(), toxicity.threatened(), toxicity.weighed()]
    for _ in range(300):
        symbols = [rnd.randrange(toxicity.SYMBOLS) for _ in range(40)]
        states, state, total, got = [p.start for p in parts], 0, 0.0, 0.0
        for symbol in symbols:
            got += toxicity.WEIGHTS[state][symbol]
            state = toxicity.FOLLOWING[state][symbol]
            for i, p in enumerate(parts):
                states[i], symbol, weight = p.step(states[i], symbol)
                total += weight
        assert np.isclose(got, total)


@pytest.mark.parametrize(
    "text, want",
    [
        ("A quiet day. Nothing of note.", []),
        ("What a moron! Fine.", [("what a moron", 3.0)]),
        ("You are a moron.", [("you are a moron", 3.5)]),  # aimed
        ("Moron, you all. A moron far away from every one of you.", [("moron, you all", 3.5), ("a moron far away from every one of you", 3.0)]),
        ("He is not a moron.", []),  # denied
        ("Not today, but what a moron.", [("not today, but what a moron", 3.0)]),  # out of the negation's reach
        ("She said the moron left.", [("she said the moron left", 0.9)]),  # told
        ("The word “moron” is old; a moron.", [("the word “moron” is old", 0.9), ("a moron", 3.0)]),
        ("I will kill you.", [("i will kill you", 4.0)]),
        ("I will not kill you. They kill time.", []),
        ("Blarg blarg\nmeh", [("blarg blarg", 8.0), ("meh", 1.0)]),
        ("İ moron", [("İ moron", 3.0)]),  # a letter whose lower case is longer
        ("", []),
    ],
)
def test_clauses(text, want):
    assert [(a.lower() if "İ" not in a else a, b) for a, b in found(text)] == want


def test_long_lines_in_pieces(monkeypatch):
    rnd = random.Random(2)
    words = ["moron", "you", "not", "said", "will", "kill", "blarg", "far", "a", "\"", ".", "meh", "word" * 9]
    text = " ".join(rnd.choice(words) for _ in range(4000))
    whole = found(text)
    monkeypatch.setattr(toxicity, "PIECE", 50)
    assert found(text) == whole and len(whole) > 100


def test_odd_rows(odd, empty, docs, labels):
    model = toxicity.train(docs, labels)
    got = toxicity.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 and r["clauses"] == [] for r in got) and len({r["score"] for r in got}) == 1
    assert toxicity.score(empty, model).count() == 0
    for none in (toxicity.train(docs, labels.limit(0)), toxicity.train(empty, labels), toxicity.train(docs, labels.where("toxic = 1"))):
        assert none.insults == {} and none.function == toxicity.START_OF_FIXED


def test_learned_words(spark):
    """Copies count once, labels that contradict each other not at all, and the order of rows does not matter."""
    rnd = random.Random(3)
    filler = lambda: " ".join(f"w{chr(97 + rnd.randrange(26))}{chr(97 + rnd.randrange(26))}" for _ in range(60))
    rows = [(i, filler() + (" grumlo" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(600)]
    copied = filler() + " onlycopied"
    rows += [(1000 + i, copied, 1) for i in range(100)]
    rows += [(2000 + i, filler() + " contested", y) for i in range(40) for y in (0, 1)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    labels = frame.select("doc_id", "toxic")
    docs = frame.select("doc_id", "text").distinct()
    model = toxicity.train(docs, labels, rows=900)
    assert model.insults == {"grumlo": toxicity.INSULT[3]}
    again = toxicity.train(docs.repartition(7), labels.orderBy(F.rand(1)), rows=900)
    assert again.insults == model.insults and again.function == model.function
    scores = dict(toxicity.score(spark.createDataFrame([(1, "so grumlo it is"), (2, "onlycopied contested")], "doc_id int, text string"), model).select("doc_id", "score").collect())
    assert scores[1] > 0.9 and scores[2] < 0.2


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = toxicity.score(docs, toxicity.train(docs, labels.where(~out))).join(labels.where(out), "doc_id").collect()
    bad = np.array([r["score"] for r in rows if r["toxic"] == 1])
    good = np.array([r["score"] for r in rows if r["toxic"] == 0])
    # Some of the labels are wrong: junk without any word of note.
    assert (bad >= 0.5).mean() > 0.9 and (good >= 0.5).mean() < 0.01 and (bad[:, None] > good).mean() > 0.9
