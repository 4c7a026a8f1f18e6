"""Quality rules: base rules, and a log-likelihood ratio of hashed n-grams between a
trusted target and the raw corpus. DataFrame functions only.

Words and pairs of words fall into buckets by a 64-bit hash. The raw multinomial counts
every document; the target multinomial counts every document that labels mark as good and
is smoothed towards the raw one, so that a bucket those never met is evidence of a fixed
size. A document's score is the mean ratio over its n-grams. The threshold is set once,
from the scores of all labelled documents (approximate percentiles), and holds for every
document.

Scoring needs no shuffle: the weights (one number per bucket) reach the tasks as one
array of fixed size. Texts are sent to the labels once, for the target's counts, and only
those whose ids pass a filter of fixed size; the threshold sends ids and scores.

Cases: a null or empty text has no words, null score, and fails the base rules; a text
with fewer than eight words has no windows; rows with null or repeated keys are judged
each for itself; a key labelled good and bad counts as both; without labels the target equals the raw corpus, all scores are zero and
only the base rules reject; an empty table gives an empty result; only the named columns
are read, so extra columns cannot clash; whole texts of any length are judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourseline.sources.storage import stage

BUCKETS = 1 << 16
MARKS = 1 << 18  # numbers of 64 bits that tell which ids may be trusted, 2 MB in all
RANKS = 100_000  # percentiles are right to one part in so many ranks
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
GAPS = r"[\x20\x09-\x0D]+"


def words_of(text: str | Column) -> Column:
    """Runs of characters other than blank and the five ASCII controls from tab to return."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAPS), "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows of `window` words that the text holds more than once."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)), lambda i: F.xxhash64(F.slice(words, i, window)))
    return F.when(F.size(words) > window, _covered(hashes, window)).otherwise(F.lit(0))


def _covered(hashes: Column, window: int) -> Column:
    def of(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_one(placed, lambda p: _sum_of_spans(p, window)))

    return _one(hashes, of)


def _sum_of_spans(placed: Column, window: int) -> Column:
    def repeats(j: Column) -> Column:
        own = F.get(placed, j)["h"]
        return F.coalesce(own == F.get(placed, j - 1)["h"], F.lit(False)) | F.coalesce(own == F.get(placed, j + 1)["h"], F.lit(False))

    found = F.filter(F.sequence(F.lit(0), F.size(placed) - 1), repeats)
    starts = F.array_sort(F.transform(found, lambda j: F.get(placed, j)["i"]))
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("words"), F.lit(0).alias("until")),
        lambda a, s: F.struct((a["words"] + s + window - F.greatest(s, a["until"])).alias("words"), (s + window).alias("until")),
        lambda a: a["words"],
    )


def _one(value: Column, use) -> Column:
    """`use(value)` with the value worked out once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def n_grams(words: Column) -> Column:
    """The buckets of a document's words and pairs of words."""
    single = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(BUCKETS)).cast("int"))
    return F.concat(single, pairs)


def labelled(labels: DataFrame, quality: int, key: str) -> DataFrame:
    """All ids with that label."""
    return labels.where((F.col("quality") == quality) & F.col(key).isNotNull()).select(key).distinct()


def sample_of(labels: DataFrame, quality: int, most: int, key: str) -> DataFrame:
    """At most `most` ids with that label."""
    own = labelled(labels, quality, key)
    return own.orderBy(F.xxhash64(key), key).limit(most)


def _marks(ids: DataFrame, key: str) -> DataFrame:
    """One row with `marks`: `MARKS` numbers whose bits tell which hashes of ids occur. Its size is fixed; the more ids
    there are, the more other ids pass, and none of the ids is ever missed."""
    place = F.pmod(F.xxhash64(key), F.lit(64 * MARKS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    words = ids.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    every = ids.sparkSession.range(MARKS).withColumnRenamed("id", "word").join(words.hint("merge"), "word", "left").na.fill(0)
    return every.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("marks"))


def _marked(key: str, marks: DataFrame) -> Column:
    place = F.pmod(F.xxhash64(key), F.lit(64 * MARKS))
    word = F.get(marks.select("marks").scalar(), F.shiftright(place, 6).cast("int"))
    return F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1


def weights(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row with `weights`: for each bucket the logarithm of target over raw probability. The raw counts need no join;
    the join of the target sends only texts whose ids are marked."""
    plain = docs.select(key, text)
    marks = stage(_marks(trusted.select(key), key), "marks")
    good = plain.where(F.col(key).isNotNull() & _marked(key, marks)).join(trusted.select(key).hint("merge"), key, "left_semi")

    def counts(rows: DataFrame, name: str) -> DataFrame:
        grams = rows.select(F.explode(_one(words_of(text), n_grams)).alias("bucket"))
        return stage(grams.groupBy("bucket").agg(F.count("*").alias(name)), name)

    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    every = every.join(counts(plain, "raw"), "bucket", "left").join(counts(good, "target"), "bucket", "left").na.fill(0)
    row = every.groupBy().agg(
        F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"),
        F.array_sort(F.collect_list(F.struct("bucket", "raw", "target"))).alias("all"),
    )
    raw = lambda c: (c["raw"] + 1) / (F.col("n_raw") + BUCKETS)
    ratio = lambda c: F.log((c["target"] + BUCKETS * raw(c)) / (F.col("n_target") + BUCKETS) / raw(c))
    return row.select(F.transform("all", ratio).alias("weights"))


def scored(docs: DataFrame, fitted: DataFrame, text: str = "text", **more) -> DataFrame:
    """`docs` with `n_words`, `score` (the mean weight of the n-grams, null without words) and `more`
    (name = function of the words and of the text). The words are split once and the weights named once, inside the
    function of the words: so they stay one shared array and no row ever holds them. The results come out of a
    generator of one row, so that a filter on one of them does not work them out again."""

    def of(words: Column) -> Column:
        total = F.aggregate(n_grams(words), F.lit(0.0), lambda s, g: s + F.get("_weights", g))
        score = F.when(F.size(words) > 0, total / (2 * F.size(words) - 1))
        return F.struct(
            F.size(words).cast("long").alias("n_words"), score.alias("score"), *(use(words).cast("long").alias(n) for n, use in more.items())
        )

    weighed = docs.withColumn("_weights", fitted.select("weights").scalar()).withColumn("_of_words", _one(words_of(text), of))
    return weighed.select(*[F.col(f"`{c}`") for c in docs.columns], F.inline(F.array("_of_words")))


def threshold(measured: DataFrame, good: DataFrame, bad: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row with `threshold`: half way from the score that only one good document in 200 stays below
    to the median of the bad ones, or just that low score if the bad ones are not below it. `measured` has `key`,
    `n_words` and `score`; nothing else is sent to the labels. An id with both labels counts on both sides."""
    both = good.withColumn("good", F.lit(True)).unionByName(bad.withColumn("good", F.lit(False)))
    known = measured.where((F.col("n_words") >= LEAST_WORDS) & F.col(key).isNotNull()).select(key, "score").join(both.hint("merge"), key)
    low = F.percentile_approx(F.when(F.col("good"), F.col("score")), 0.005, RANKS)
    middle = F.percentile_approx(F.when(~F.col("good"), F.col("score")), 0.5, RANKS)
    return known.groupBy().agg(low.alias("low"), middle.alias("middle")).select(
        F.coalesce((F.col("low") + F.least("middle", "low")) / 2, F.lit(-1e300)).alias("threshold")
    )


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `key`, `n_words`, the four base counts, `base_failed`, `score`, `threshold`, `kept`."""
    return _judged(docs.select(key, text), labels, key, text, [key])


def keep(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""
    whole = docs.select(key, text, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return _judged(whole, labels, key, text, [key, "_row"]).where("kept").select("_row.*")


def _judged(docs: DataFrame, labels: DataFrame, key: str, text: str, columns: list[str]) -> DataFrame:
    """The columns of `docs` named in `columns`, with the measures of the text and the verdict. Each text is measured
    once and the measures are stored with those columns: the threshold and the verdict come from them."""
    good, bad = (labelled(labels, q, key) for q in (1, 0))
    fitted = stage(weights(docs, good, key, text), "weights")
    rows = scored(docs, fitted, text, word_chars=lambda w: F.length(F.array_join(w, "")), n_repeat_words=repeated_words)
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        *columns, "n_words", "word_chars",
        F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _one(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", "score",
    )
    rows = stage(rows, "measured")
    limit = stage(threshold(rows, good, bad, key), "threshold")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = rows.withColumn("threshold", limit.select("threshold").scalar()).withColumn("base_failed", failed)
    return rows.withColumn("kept", ~failed & (F.col("score") >= F.col("threshold")))
