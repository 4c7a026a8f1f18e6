"""Pseudonyms, nearest neighbours, fixity audit, and the pipeline's stages."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bourseline.llm import ann, fixity, pseudonyms, queries

SF = "/root/testdata/sf0.001"


def replaced(spark, texts, key="k"):
    rows = pseudonyms.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), key).orderBy("i").collect()
    return [r["text"] for r in rows], [[p["kind"] for p in r["pii"]] for r in rows]


def test_kinds_and_formats(spark):
    texts = [
        "call +1 (017) 555-7713 2024-05-06 ok", "a.99@mail6.example.com, A.99@MAIL6.EXAMPLE.COM", "4111111111111111 or 4111 1111 1111 1111, not 4111111111111112", "ip 10.0.0.255, not 300.1.1.1",
        "DE89 3704 0044 0532 0130 00 is DE89370400440532013000", "123-45-6789, not 000-12-3456", "05.06.2024 31/12/1999 May 5, 2024 32.01.2024", 'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"', None, "", "3 and 4.0",
    ]
    new, kinds = replaced(spark, texts)
    assert kinds == [["phone", "date"], ["email"] * 2, ["card"] * 2, ["ip"], ["iban"] * 2, ["ssn"], ["date"] * 3, ["secret"], [], [], []]
    assert new[8:] == [None, "", "3 and 4.0"]
    for old, own in zip(texts[:8], new):
        shape = lambda s: "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else c for c in s)
        assert old != own
        if "token" not in old and "May" not in old and "ip " not in old:
            assert shape(old) == shape(own)
    assert new[1].split(", ")[1] == new[1].split(", ")[0].upper()
    assert new[2].split()[0] == "".join(new[2].replace(",", "").split()[2:6])  # equal values, two spellings
    assert "4111111111111112" in new[2] and "300.1.1.1" in new[3] and "000-12-3456" in new[5]
    digits = new[2].split()[0]
    assert sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits)) % 10 == 0
    account = new[4].split()[-1]
    assert int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1
    assert replaced(spark, texts)[0] == new and replaced(spark, texts, "other")[0][:8] != new[:8]


def test_permutations_are_one_to_one(spark):
    n = 189 * 773
    days = spark.range(n).select(pseudonyms.permuted_number(F.col("id"), 189, 773, "k", "date").alias("x"))
    assert days.agg(F.count_distinct("x"), F.min("x"), F.max("x")).first()[:] == (n, 0, n - 1)
    texts = spark.range(10000).select(pseudonyms.permuted_text(F.lpad(F.col("id").cast("string"), 4, "0"), "k", "c").alias("x"))
    assert texts.agg(F.count_distinct("x"), F.min(F.length("x"))).first()[:] == (10000, 4)


def test_values_beside_each_other(spark):
    new, kinds = replaced(spark, ["7536784127813050 4845168114407329", "x.1@a.example.com +1 (168) 555-5254 203.0.113.9"])
    assert kinds == [["card", "card"], ["email", "phone", "ip"]]


def test_equal_values_in_other_forms_stay_linked(spark):
    new, kinds = replaced(spark, ["+49 (0) 30 123456", "+49 30 123456", "+49 (0)30 123456", "010.001.001.001", "10.1.1.1", "10.01.1.1"])
    assert kinds == [["phone"]] * 3 + [["ip"]] * 3
    assert new[0].replace("(0) ", "") == new[1] == new[2].replace("(0)", "") and "(0)" in new[0] and new[1] != "+49 30 123456"
    assert [int(x) for x in new[3].split(".")] == [int(x) for x in new[4].split(".")] == [int(x) for x in new[5].split(".")]
    assert [len(x) for x in new[3].split(".")] == [3, 3, 3, 3] and not any(len(x) > 1 and x[0] == "0" for x in new[4].split("."))


def test_values_before_short_words_and_other_kinds(spark):
    ibans = ["ES91 2100 0418 4502 0005 1332", "SE45 5000 0000 0583 9825 7466", "AT61 1904 3002 3457 3201", "PL61 1090 1014 0000 0712 1981 2874", "BE68 5390 0754 7034", "DE89 3704 0044 0532 0130 00"]
    phones = ["+44 20 7946 0958", "+49 30 123456", "+1 (017) 555-7713"]
    others = {"date": "2024-05-06", "ip": "10.0.0.255", "card": "4111 1111 1111 1111", "ssn": "123-45-6789", "iban": ibans[0]}
    rows = [(f"{v} {after}", v, [kind]) for kind, own in (("iban", ibans), ("phone", phones)) for v in own for after in ("is mine", "a b", "", "and so on")]
    rows += [(f"{v} {other}", v, [kind, k]) for kind, own in (("iban", ibans), ("phone", phones)) for v in own for k, other in others.items()]
    rows += [("+44 20 7946 0958 12 items", phones[0], ["phone"]), ("ES91 2100 0418 4502 0005 1332 12 34", ibans[0], ["iban"])]
    new, kinds = replaced(spark, [text for text, _, _ in rows])
    alone = dict(zip(ibans + phones, replaced(spark, ibans + phones)[0]))
    for (text, value, want), got, own in zip(rows, new, kinds):
        assert own == want and got.startswith(alone[value]) and alone[value] != value, (text, got, own)


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_pseudonyms_on_odd_rows(table, request):
    rows = request.getfixturevalue(table)
    got = pseudonyms.pseudonymise(rows, "k")
    assert got.columns == [*rows.columns, "pii"]
    assert sorted(map(str, got.drop("pii").collect())) == sorted(map(str, rows.collect()))


def brute(rows, asked, k):
    out = {}
    for i, q in rows:
        if i in asked:
            near = sorted((-float(np.dot(q, v)), j) for j, v in rows if j != i)[:k]
            out[i] = [j for _, j in near]
    return out


def test_neighbours_with_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 4)
    rng = np.random.default_rng(5)
    v = rng.integers(-8, 8, (600, 8)).astype(float)
    v[100:350] = v[100]  # a hot group of copies
    data = [(i, [float(x) for x in row], 1) for i, row in enumerate(v)]
    odd = [(1000, None, 1), (1001, [0.0] * 8, 1), (1002, [float("nan")] * 8, 1), (1003, [None] * 8, 1), (1004, [float("inf")] * 8, 1), (None, [1.0] * 8, 1), (1005, [1.0, 2.0], 1), (1006, [], 1)]
    table = spark.createDataFrame(data + odd, "vec_id bigint, embedding array<float>, rank int")
    got = ann.search(ann.usable(table, "vec_id", "embedding"), F.col("id") % 20 == 0, 20, target=1.0).orderBy("query_id", "rank").collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append(r["vec_id"])
        assert np.isclose(r["score"], v[r["query_id"]] @ v[r["vec_id"]])
    rows = [(i, row) for i, row in enumerate(v) if row.any()]
    want = brute(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    assert set(found) == set(want) and all(len(x) == 20 for x in found.values())
    hits = sum(len(set(found[i]) & set(want[i])) for i in want) / (20 * len(want))
    assert hits >= 0.95
    assert found[100] == want[100]  # ties go to the smaller ids
    assert ann.search(ann.usable(table.limit(0), "vec_id", "embedding"), F.col("id") % 20 == 0, 20).count() == 0
    few = ann.usable(table.limit(3), "vec_id", "embedding")
    assert ann.search(few, F.col("id") == 0, 20).count() == 2


def test_tight_clusters_and_other_dimensions(spark, monkeypatch):
    """Leaves of a few vectors each, where the calibrated visits would not hold k others; and vectors of two more dimensions."""
    rng = np.random.default_rng(4)
    monkeypatch.setattr(ann, "LEAF_ROWS", 4)
    monkeypatch.setattr(ann, "LEAST_OF_SAMPLE", 2)
    monkeypatch.setattr(ann, "calibrated", lambda *a: 1)
    rows = [(i, (rng.normal(size=6) * 0.01 + 10 * np.eye(6)[i % 6] * (1 + i % 5)).tolist()) for i in range(400)]
    rows += [(1000 + 20 * i, rng.normal(size=3).tolist()) for i in range(30)] + [(5000, [1.0]), (5020, [2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in ann.search(ann.usable(table, "vec_id", "embedding"), F.col("id") % 20 == 0, 20).collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    sizes = {i: len(v) for i, v in rows}
    assert {i: len(x) for i, x in found.items()} == {i: 1 if i >= 5000 else 20 for i, _ in rows if i % 20 == 0}
    assert all(sizes[q] == sizes[v] for q, own in found.items() for v in own)


def test_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = queries.op4_ann(spark, SF).collect()
    v = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in rows.collect()}
    want = brute([(i, x) for i, x in v.items() if x.any()], {i for i in v if i % 20 == 0}, 20)
    hits = sum(r["vec_id"] in want[r["query_id"]] for r in got)
    assert hits / sum(map(len, want.values())) >= 0.9


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, state string")


def test_audit_finds_each_damage(spark):
    rnd = random.Random(1)
    rows = [(i, f"http://h/{i}", "x" * rnd.randrange(2000), "s") for i in range(5000)] + [(None, None, None, None), (7, "http://h/7", "again", "s")]
    damaged = [r for r in rows if r[0] != 1500]  # lost; what follows in its file is moved
    damaged = [(r[0], r[1], "y" + r[2][1:], r[3]) if r[0] == 4321 else r for r in damaged] + [(2999, "http://h/new", "new", "s")]
    got = fixity.audit(fixity.records(pages(spark, rows)), fixity.records(pages(spark, damaged))).collect()
    states = {}
    for r in got:
        states.setdefault(r["state"], []).append(r["key"])
    assert states["missing"] == [1500] and sorted(states["changed"] + states.get("extra", [])) == [2999, 4321] or states["extra"] == [2999]
    assert sorted(states["moved"])[0] == 1501 and set(k // 1000 for k in states["moved"]) <= {1, 2}
    assert fixity.audit(fixity.records(pages(spark, rows)), fixity.records(pages(spark, rows[::-1]))).count() == 0


def test_audit_finds_all_that_one_byte_moves(spark):
    rows = [(i, f"http://h/{i}", "x" * 2000, "s") for i in range(1500)]  # some eight ranges in a file
    shorter = [(r[0], r[1], r[2][1:] if r[0] == 3 else r[2], r[3]) for r in rows]
    got = fixity.audit(fixity.records(pages(spark, rows)), fixity.records(pages(spark, shorter))).collect()
    assert [r["key"] for r in got if r["state"] == "changed"] == [3]
    moved = [r for r in got if r["state"] == "moved"]
    assert sorted(r["key"] for r in moved) == list(range(4, 1000)) and all(r["offset"] - r["other_offset"] == 1 for r in moved)
    assert len(got) == 1 + len(moved)


def test_audit_of_empty_replicas(spark):
    none, one = pages(spark, []), pages(spark, [(1, "u", "h", "s"), (900000, "u", "h", "s")])
    assert fixity.audit(fixity.records(none), fixity.records(none)).count() == 0
    assert {r["state"] for r in fixity.audit(fixity.records(one), fixity.records(none)).collect()} == {"missing"}
    assert {r["state"] for r in fixity.audit(fixity.records(none), fixity.records(one)).collect()} == {"extra"}


def test_stages_keep_the_columns(spark, odd):
    docs = odd
    for _, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, docs, SF)
        assert kept.columns == docs.columns
        before = {(r["doc_id"], r["length"]) for r in docs.collect()}
        rows = kept.collect()
        assert {(r["doc_id"], r["length"]) for r in rows} <= before
        docs = spark.createDataFrame(rows, docs.schema)
    assert corpus_pipeline.packed(spark, docs, SF).count() >= docs.count()


NAMES = "id hash row host text_hash other its place pii _id _hash _found _new _place found new _row _weights _of_words n_words score threshold kept band component".split()


def test_no_column_of_the_documents_meets_an_inner_name(spark, docs):
    mail = "write to jo.smith@example.com or +49 30 123456 "
    rows = docs.limit(40).withColumn("text", F.concat(F.lit(mail), "text")).select("*", *[F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in NAMES])
    for _, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, rows, SF)
        assert kept.columns == rows.columns
        data = kept.collect()
        assert data and all(r[n] == f"{n}-{r['doc_id']}" for r in data for n in NAMES)
        rows = spark.createDataFrame(data, rows.schema)
    assert not any("jo.smith" in str(v) or "30 123456" in str(v) for r in data for v in r)
    assert corpus_pipeline.packed(spark, rows, SF).count() >= len(data)


def test_pipeline(spark, docs):
    """Each stage against the operator's own verdict on its input, and the tokens against the texts that were left."""
    left = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        rows = {r["doc_id"]: r["text"] for r in step(spark, left, SF).collect()}
        before = {r["doc_id"]: r["text"] for r in left.collect()}
        if name == "near-duplicates":
            from test_minhash import brute as by_pairs

            assert set(rows) == {k for k, _, c in by_pairs(list(before.items()), 5) if k == c}
        if name == "personal data":
            assert set(rows) == set(before) and not any("555-" in t and t == before[i] for i, t in rows.items())
        left = left.where(F.col("doc_id").isin(list(rows))) if name != "personal data" else spark.createDataFrame([(i, t) for i, t in rows.items()], "doc_id bigint, text string")
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in left.collect()}
    assert sum(r["doc_tokens"] for r in got if r["start"] == 0) == sum(r["length"] for r in got)


def test_empty_corpus(spark, empty):
    docs = empty
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
        assert docs.count() == 0


def test_every_operator_has_a_query():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
