"""Quality rules and classifier, language, licences."""

import collections
import re
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from bourseline.llm import language, licences, quality_cnn, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(repeated), failed


@pytest.mark.parametrize("table", ["odd", "empty", "docs"])
def test_base_rules(table, request, labels):
    docs = request.getfixturevalue(table)
    rows = quality_rules.judge(docs, labels).collect()
    got = sorted((r["doc_id"] or -1, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in rows)
    assert got == sorted((r["doc_id"] or -1, *base(r["text"])) for r in docs.collect())
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= r["threshold"]) for r in rows)


def test_ratio_against_counts_by_hand(spark, docs, labels):
    good = quality_rules.sample_of(labels, 1, 50, "doc_id")
    fitted = quality_rules.weights(docs, good)
    table = np.array(fitted.first()["weights"])
    texts = docs.select("doc_id", quality_rules._one(quality_rules.words_of("text"), quality_rules.n_grams).alias("grams")).collect()
    ids = {r["doc_id"] for r in good.collect()}
    size = quality_rules.BUCKETS
    raw = np.bincount([g for r in texts for g in r["grams"]], minlength=size)
    target = np.bincount([g for r in texts if r["doc_id"] in ids for g in r["grams"]], minlength=size)
    p = (raw + 1) / (raw.sum() + size)
    want = np.log((target + size * p) / (target.sum() + size) / p)
    assert np.allclose(table, want)
    scores = {r["doc_id"]: r["score"] for r in quality_rules.scored(docs, fitted).collect()}
    for r in texts:
        if r["grams"]:
            assert np.isclose(scores[r["doc_id"]], want[r["grams"]].mean())


def test_rules_separate_the_labels(docs, labels):
    judged = quality_rules.judge(docs, labels).join(labels, "doc_id").where("NOT base_failed")
    share = {r["quality"]: r["share"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.99 and share.get(0, 0) < 0.3


def test_target_counts_every_good_label(spark):
    rows = [(i, "old words") for i in range(10_050)] + [(-1, "rare words " * 10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = quality_rules.judge(docs, docs.select("doc_id", F.lit(1).alias("quality")))
    texts = docs.select("text", quality_rules._one(quality_rules.words_of("text"), quality_rules.n_grams).alias("g")).collect()
    size = quality_rules.BUCKETS
    raw = np.bincount([g for r in texts for g in r["g"]], minlength=size)
    p = (raw + 1) / (raw.sum() + size)
    want = np.log((raw + size * p) / (raw.sum() + size) / p)  # all are good, so the target is the raw corpus
    scores = dict(got.select("doc_id", "score").collect())
    assert np.isclose(scores[0], want[texts[0]["g"]].mean(), rtol=1e-9) and np.isclose(scores[-1], want[texts[-1]["g"]].mean(), rtol=1e-9)



def test_rules_without_labels(docs, labels):
    assert quality_rules.judge(docs, labels.limit(0)).where("kept = base_failed").count() == 0


def test_keep_has_all_columns(odd, labels):
    assert quality_rules.keep(odd, labels).columns == odd.columns


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_classifier_on_odd_rows(table, request, docs, labels):
    rows = request.getfixturevalue(table)
    network = quality_cnn.train(docs, labels, rows=30)
    got = quality_cnn.score(rows, network).collect()
    assert len(got) == rows.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["score"] == 0.5 for r in quality_cnn.score(rows, quality_cnn.train(docs, labels.limit(0))).collect())


def test_classifier_scores_whole_texts(monkeypatch):
    rng = np.random.default_rng(0)
    network = quality_cnn.Network(rng.normal(size=(8, 256, 16)).astype("f4"), rng.normal(size=16).astype("f4"), rng.normal(size=16).astype("f4"), 0.1)
    text = rng.integers(1, 256, 1000, dtype=np.uint8)
    response = np.stack([sum(network.filters[t][text[i + t]] if i + t < 1000 else network.filters[t][0] for t in range(8)) for i in range(1000)])
    blocks = np.stack([response[i : i + 128].max(0) for i in range(0, 1000, 128)]) + network.bias
    chunks = np.maximum(np.maximum(blocks[:-1], blocks[1:]), 0) @ network.weights
    want = 1 / (1 + np.exp(-(chunks.mean() + 0.1)))
    scorer = quality_cnn.Scorer(network)
    assert np.isclose(scorer.score([b"other", text.tobytes(), b""])[1], want, atol=1e-4)
    monkeypatch.setattr(quality_cnn, "PART", 256)
    assert np.isclose(scorer.score([text.tobytes()])[0], want, atol=1e-4)


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = quality_cnn.score(docs, quality_cnn.train(docs, labels.where(~out))).join(labels.where(out), "doc_id").collect()
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert (good >= 0.3).mean() > 0.97


def test_fits_take_texts_of_any_length(spark):
    """One label, and one language, only in long texts; ids that repeat with other texts or labels; the order of rows does not matter."""
    rnd = np.random.default_rng(1)
    good = [(i, "calm words of a quiet day " * int(rnd.integers(3, 9)), "en", 1) for i in range(60)]
    bad = [(100 + i, "### $$$ %%% &&& " * 6000 + "x" * int(rnd.integers(1, 99)), "xx", 0) for i in range(60)]
    more = [(1, "another text of the first id", "en", 1), (500, "both labels", "en", 0), (500, "both labels", "en", 1)] + [(2, "copied", "en", 1)] * 50
    frame = spark.createDataFrame(good + bad + more, "doc_id bigint, text string, lang string, quality int")
    docs, labels = frame.drop("quality"), frame.select("doc_id", "quality")
    network = quality_cnn.train(docs, labels)
    again = quality_cnn.train(docs.repartition(5), labels.orderBy(F.rand(3)))
    assert all(np.array_equal(getattr(network, f), getattr(again, f)) for f in ("filters", "bias", "weights")) and network.shift == again.shift
    scores = {r["doc_id"]: r["score"] for r in quality_cnn.score(docs.where("doc_id IN (3, 4, 103, 104)"), network).collect()}
    assert min(scores[3], scores[4]) > 0.5 > max(scores[103], scores[104])
    assert language.train(docs)[0] == ["en", "xx"]
    known = language.identify(docs.where("doc_id IN (3, 104)").withColumn("host", F.lit(None).cast("string")), language.train(docs), ["doc_id"])
    assert {r["doc_id"]: r["language"] for r in known.collect()}[3] == "en"


def test_excerpts_reach_from_end_to_end(spark):
    text = "".join(chr(97 + i * 26 // 100_000) for i in range(100_000))
    got = [bytes(r["e"]).decode() for r in spark.createDataFrame([(text,), ("short é",), (None,)], "t string").select(quality_cnn.excerpt("t", 2600, 13).alias("e")).collect()]
    assert len(got[0]) == 2600 and got[0][0] == "a" and got[0][-1] == "z" and len(set(got[0])) >= 13 and got[1:] == ["short é", ""]


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_language_of_odd_rows(table, request, docs):
    rows = request.getfixturevalue(table).withColumn("host", F.col("source"))
    got = language.identify(rows, language.train(docs), ["doc_id"]).collect()
    assert len(got) == rows.count()
    assert all(not r["kept"] for r in got if r["doc_id"] in (1, 2, 3))
    assert all(r["language"] == "en" and r["kept"] for r in got if r["doc_id"] == 6)
    none = language.identify(rows, language.train(docs.limit(0)), ["doc_id"]).collect()
    assert len(none) == len(got) and not any(r["kept"] for r in none)


def test_language_by_evidence(spark, docs):
    model = language.train(docs)
    fr = docs.where("lang = 'fr' AND n_chars > 400").first()["text"]
    rows = [(i, fr, "fr", "a.org", "a.org", "org") for i in range(40)] + [(100, "x", None, "a.org", "a.org", "org"), (101, "x", "de", "b.net", "b.net", "net"), (102, None, "fr", "a.org", "a.org", "org")]
    rows += [(103, "Привет, как дела, что нового у вас сегодня. " * 8, None, None, None, None)]
    got = {r["id"]: r for r in language.identify(spark.createDataFrame(rows, "id int, text string, declared string, host string, domain string, suffix string"), model, ["id"]).collect()}
    assert got[0]["language"] == "fr" and got[0]["probability"] > 0.99
    assert got[100]["language"] == "fr"  # one letter says little, the host says much
    assert not got[102]["kept"] and not got[103]["kept"]


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = docs.where(out).withColumn("host", F.col("source"))
    got = language.identify(rows, language.train(docs.where(~out)), ["doc_id"]).join(docs, "doc_id")
    assert got.where("language = lang").count() / got.count() > 0.97


def test_pages(spark):
    page = [(1, "https://www.Blog.example.com:80/en/1?x#y", '<html lang="EN"><head><title>t</title></head><body><script>var x;</script><p>Some text &amp; more</p></body></html>'), (2, None, None)]
    a, b = language.page_evidence(spark.createDataFrame(page, "page_id int, url string, html string")).orderBy("page_id").collect()
    assert (a["host"], a["domain"], a["suffix"], a["declared"], a["text"].split()) == ("blog.example.com", "example.com", "com", "en", ["Some", "text", "more"])
    assert b["host"] is None and b["text"] is None


def test_licences(spark, docs, odd, empty):
    model = licences.train(docs)
    lines = {
        "Released under the MIT License.": "MIT", "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Licensed under CC BY-SA 4.0.": "CC-BY-SA", "The driving license was renewed by the licensing board.": None, "We compared the MIT License with the Apache License.": None,
    }
    data = [(i, f"some first line of words\n\n{line}\nand a last one") for i, line in enumerate(lines)]
    got = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(data, "doc_id int, text string"), model).collect()}
    for (i, text), want in zip(data, lines.values()):
        assert [s["family"] for s in got[i]["licences"]] == ([want] if want else []), text
        assert got[i]["n_paragraphs"] == 3
        assert all(text[s["start"] : s["end"]] in lines for s in got[i]["licences"])
    assert licences.scan(odd, model).where("size(licences) > 0").count() == 0
    assert licences.scan(empty, licences.train(empty)).count() == 0


def test_every_template_is_found_on_its_own(spark, docs):
    lines = [(line, family) for family, own in licences.TEMPLATES.items() for line in own]
    lines += [("Released under GPLv3.", "GPL-3.0"), ("Available under CC BY-SA 4.0.", "CC-BY-SA"), ("Distributed under Apache 2.0.", "Apache-2.0"), ("The report was released under the old rules.", None)]
    rows = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(lines)], "doc_id int, text string")
    got = {r["doc_id"]: [x["family"] for x in r["licences"]] for r in licences.scan(rows, licences.train(docs)).collect()}
    assert [(line, got[i]) for i, (line, _) in enumerate(lines)] == [(line, [family] if family else []) for line, family in lines]


def test_wrapped_notices(spark, docs):
    texts, wants = [], []
    for mark in ("", "# ", " * ", "// ", "dnl "):
        for family, own in licences.TEMPLATES.items():
            for notice in own:
                if len(notice) > 75:
                    lines = [mark + x for x in textwrap.wrap(notice, 50)]
                    texts.append("\n".join(["é some words of a first line", mark.rstrip(), *lines, mark.rstrip(), "and a last line"]))
                    wants.append([(family, "\n".join(lines))])
    texts.append("It was licensed under the\nold rules of the town, and nobody read the license\nof the MIT museum.")
    wants.append([])
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r for r in licences.scan(rows, licences.train(docs)).collect()}
    for i, (text, want) in enumerate(zip(texts, wants)):
        assert [(x["family"], text[x["start"] : x["end"]]) for x in got[i]["licences"]] == want, text
        assert got[i]["n_paragraphs"] == sum(bool(x.strip()) for x in text.split("\n"))


def test_licence_lines_of_the_documents(docs):
    known = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC"}
    for r in licences.scan(docs, licences.train(docs)).join(docs, "doc_id").collect():
        want = {f for line, f in known.items() if line in r["text"]}
        assert want <= {s["family"] for s in r["licences"]}
