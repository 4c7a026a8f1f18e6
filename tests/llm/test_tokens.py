"""Packing and byte-level BPE against the libraries' own tokenizers."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from bourseline.llm import byte_bpe, packing

WORDS, BYTES = P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTES, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_and_ids_of_random_texts(plain):
    rnd = random.Random(3)
    letters = "ab'stmdrevl  \n\t\x0b 　 12²Ⅷ.,!?é中\U0001f600\x1c\x85'"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(50))) for _ in range(3000)] + ["", "x" * 3000, "ab " * 500]
    words = byte_bpe.vocabulary(BYTES)
    for text, slices in zip(texts, byte_bpe.pieces(texts)):
        assert "".join(slices) == text
        ids = words.encode(slices)
        assert ids.tolist() == plain.encode_ordinary(text)
        assert words.decode(ids, words.offsets(ids)) == text.encode()


def test_scan_in_blocks_is_the_scan_in_one(monkeypatch):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("a' stre vl\n1.") for _ in range(200)) for _ in range(100)]
    whole = byte_bpe.pieces(texts)
    monkeypatch.setattr(byte_bpe, "BLOCK", 7)
    assert byte_bpe.pieces(texts) == whole


@pytest.mark.parametrize("table", ["odd", "empty", "docs"])
def test_encode_and_decode(table, request, plain):
    docs = request.getfixturevalue(table)
    rows = byte_bpe.decode(byte_bpe.encode(docs, BYTES), BYTES).collect()
    want = sorted((r["doc_id"] or -1, tuple(plain.encode_ordinary(r["text"] or "")), (r["text"] or "").encode()) for r in docs.collect())
    assert sorted((r["doc_id"] or -1, tuple(np.frombuffer(r["ids"], "<u4").tolist()), bytes(r["bytes"])) for r in rows) == want


def check_packing(rows, size):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return sum(r["length"] for r in rows) / (size * max(1, len(by_sequence)))


@pytest.mark.parametrize("table", ["odd", "empty", "docs"])
def test_packing(table, request):
    docs = request.getfixturevalue(table)
    rows = packing.assign(packing.tokenize(docs, WORDS)).collect()
    check_packing(rows, packing.SIZE)
    plain = Tokenizer.from_file(WORDS)
    want = sorted((r["doc_id"] or -1, zlib.crc32(np.array(plain.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4").tobytes())) for r in docs.collect())
    whole = {}
    got = []
    for r in sorted(rows, key=lambda r: r["start"]):
        if r["doc_tokens"] == r["length"]:
            got.append((r["doc_id"] or -1, zlib.crc32(r["ids"])))
        else:
            whole.setdefault(r["doc_id"], []).append(bytes(r["ids"]))
    got += [(i or -1, zlib.crc32(b"".join(x))) for i, x in whole.items()]
    assert sorted(got) == want


def test_patterns_use_up_the_histogram_and_waste_little():
    rnd = random.Random(1)
    histogram = {}
    for _ in range(20000):
        length = min(512, 1 + int(rnd.expovariate(1 / 90)))
        histogram[length] = histogram.get(length, 0) + 1
    found = packing.patterns(histogram, 512)
    left = dict(histogram)
    for count, content in found:
        assert sum(length * copies for length, copies in content) <= 512
        for length, copies in content:
            left[length] -= count * copies
    assert set(left.values()) == {0}
    total = sum(k * v for k, v in histogram.items())
    assert total / (512 * sum(c for c, _ in found)) > 0.95
    assert packing.patterns({}) == [] and packing.patterns({5: 3}, 5) == [(3, [(5, 1)])]


def test_ranks_over_many_tasks(spark):
    rows = spark.range(500).selectExpr("id doc_id", "id % 3 + 1 length").repartition(23)
    assert check_packing(packing.assign(rows, 16).collect(), 16) > 0.99


def test_numbered_pieces_must_all_be_there(docs):
    pieces = packing.tokenize(docs, WORDS, numbered=True)
    assert check_packing(packing.assign(pieces).collect(), packing.SIZE) > 0.9
    with pytest.raises(ValueError, match="left out"):
        packing.assign(pieces.where("doc_id % 2 = 0"))


def test_pieces_are_not_exchanged(spark, docs):
    """Only the tasks' sums move; the stored pieces are read where they lie."""
    plan = packing.assign(packing.tokenize(docs, WORDS, numbered=True))._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan


def test_words_with_punctuation_are_encoded_like_texts():
    rnd = random.Random(6)
    letters = "abs'tdm1é中́²_.,!*|-"
    words = packing.Words(WORDS)
    texts = [" ".join("".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 7))) for _ in range(30)) for _ in range(1500)]
    plain = Tokenizer.from_file(WORDS)
    got = words.ids([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    words.old, words.young = words.young, {}
    assert words.ids([t.encode() for t in texts]) == got


def test_every_code_point_has_the_encoders_class():
    """A vocabulary whose only merges join a figure, a letter or a mark to the first byte after it tells which piece a character is in."""
    ranks = {bytes([b]): b for b in range(256)}
    for lead in b"a1!":
        for b in range(128, 256):
            ranks[bytes([lead, b])] = len(ranks)
    probe = tiktoken.Encoding("probe", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    leads = {"a": byte_bpe.LETTER, "1": byte_bpe.NUMBER, "!": byte_bpe.OTHER}
    classes = byte_bpe._classes()
    for c in [*range(0x80, 0xD800), *range(0xE000, 0x110000)]:
        joined = [kind for lead, kind in leads.items() if probe.encode_ordinary(lead + chr(c))[0] >= 256]
        assert joined == [kind for kind in leads.values() if kind == classes[c]], hex(c)


def test_characters_new_to_unicode_16(plain):
    words = byte_bpe.vocabulary(BYTES)
    for c in "\U000105e7Ᲊ\U00010d4a\U00010d40\U000116d0\U000143fa":
        for text in (f"a{c}{c}a", f"1{c} {c}!", f"'s{c}  {c}"):
            assert words.encode(byte_bpe.pieces([text])[0]).tolist() == plain.encode_ordinary(text)


def test_punctuation_after_every_code_point():
    """Words are encoded apart from the punctuation at their ends; the ids must be those of the whole."""
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    own = packing.Words(WORDS)
    every = [chr(c) for c in [*range(0x21, 0xD800), *range(0xE000, 0x110000)] if not chr(c).isspace() and (chr(c).isalnum() or c % 64 == 0)]
    for at in range(0, len(every), 20_000):
        texts = [f"{c}. a{c}!" for c in every[at : at + 20_000]]
        want = [np.array(e.ids, dtype="<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
        got = own.ids([t.encode() for t in texts])
        assert [t for t, a, b in zip(texts, got, want) if a != b] == []


def test_random_texts_with_letters_that_end_in_marks():
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    rnd = random.Random(9)
    letters = "İı.,!'s aé́̇क़Σς1ǰﬁ-"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 25))) for _ in range(30_000)]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    got = packing.Words(WORDS).ids([t.encode() for t in texts])
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []
