"""Language identification by Bayesian fusion of evidence.

Evidence about a row: the likelihood of its text (byte trigrams, one multinomial per
language, fitted on at most `FIT_ROWS` labelled documents of each, of any length, long ones by
excerpts spread over the whole text), the language its markup
declares, the suffix of its address, and the prior of its host. The last three are tables
counted over all rows by grouped aggregation, with what the text alone says as the label:

* P(declared | language) and P(suffix | language), smoothed towards their marginals;
* P(language | host), smoothed towards the host's domain, which is smoothed towards all
  rows. A row's own vote is taken out of its host's and domain's counts.

A missing piece of evidence says nothing. A text's log-likelihood counts as that of at most
`MOST_TRIGRAMS` independent trigrams, since neighbouring ones are not independent.

A row is kept if its best language reaches `LEAST_PROBABILITY` and its text looks like some
language: its mean log-likelihood per trigram must not fall more than `SLACK` (and a part
that shrinks with the root of the length) below the tenth percentile of the fitted
documents of that language.

Cases: a null text, or one without a letter, has no text evidence and is not kept; nulls in
any other column are missing evidence; rows may repeat; without a labelled document there
is no model, and no row has a language; an empty table gives an empty result; only the named columns are read, so extra columns cannot clash; whole texts of any
length are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourseline.llm.byte_bpe import sliced
from bourseline.llm.quality_cnn import excerpt
from bourseline.sources.storage import stage

FIT_ROWS = 300  # labelled documents per language that the fit takes at most, by excerpts (see `excerpt`)
SOME = 20  # trigrams of a text whose mean likelihood says something
SLOTS = 1 << 16
MOST_TRIGRAMS = 60
SMOOTHING = 20.0  # rows that a prior one level up weighs
LEAST_PROBABILITY = 0.5
SLACK, SLACK_OF_ONE = 3.0, 25.0
PART = 1 << 18


def _slots(text: bytes) -> np.ndarray:
    """The trigrams of a text in lower case, as numbers below 2^16."""
    b = np.frombuffer(b" " + text.lower() + b" ", dtype=np.uint8).astype(np.uint32)
    return ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(16)


def _mean_likelihoods(text: bytes, table: np.ndarray) -> tuple[np.ndarray, int]:
    slots = _slots(text)
    total = np.zeros(table.shape[1])
    for at in range(0, len(slots), PART):
        total += table[slots[at : at + PART]].sum(0, dtype=np.float64)
    return total / max(1, len(slots)), len(slots)


def fit(samples: dict[str, list[bytes]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log-probabilities of slots by language, the lowest mean log-likelihood of each language's own documents)."""
    names = sorted(samples)
    table = np.empty((SLOTS, len(names)), dtype=np.float32)
    for k, name in enumerate(names):
        counts = np.full(SLOTS, 0.1)
        for text in samples[name]:
            counts += np.bincount(_slots(text), minlength=SLOTS)
        table[:, k] = np.log(counts / counts.sum())
    # A tenth of the lowest are passed over: labels can be wrong.
    lowest = np.empty(len(names))
    for k, name in enumerate(names):
        means = [_mean_likelihoods(t, table) for t in samples[name]]
        telling = [m for m in means if m[1] >= SOME] or means
        lowest[k] = np.quantile([m[0][k] for m in telling], 0.1)
    return names, table, lowest


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = FIT_ROWS):
    """Fit on at most `rows` documents of each language, those with the lowest hashes of their keys."""
    own = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.xxhash64(key).alias("h"), excerpt(text).alias("t"), F.col(lang).alias("y"))
    place = F.row_number().over(Window.partitionBy("y").orderBy("h", "t"))
    samples: dict[str, list[bytes]] = {}
    for r in own.withColumn("place", place).where(F.col("place") <= rows).orderBy("y", "h", "t").collect():  # bounded: languages x rows
        samples.setdefault(r["y"], []).append(bytes(r["t"]))
    return fit(samples) if samples else None


def text_evidence(rows: DataFrame, model, text: str = "text") -> DataFrame:
    """`rows` without its text, with `trigrams` (their number), `likelihoods` (one per language, tempered) and `mean_likelihoods`; null without a letter."""
    names, table, _ = model
    others = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, 0):
                means, tempered, sizes = [], [], []
                for t in part.column(0).to_pylist():
                    if t is None or not any(map(str.isalpha, t)):
                        means.append(None)
                        tempered.append(None)
                        sizes.append(None)
                        continue
                    mean, n = _mean_likelihoods(t.encode("utf-8", "surrogatepass"), table)
                    means.append(mean)
                    sizes.append(n)
                    tempered.append(mean * min(n, MOST_TRIGRAMS))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(tempered, pa.list_(pa.float64())), pa.array(means, pa.list_(pa.float64())), pa.array(sizes, pa.int64())],
                    names=[*others, "likelihoods", "mean_likelihoods", "trigrams"],
                )

    rest = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others)
    return rows.select(text, *others).mapInArrow(run, f"{rest}, likelihoods array<double>, mean_likelihoods array<double>, trigrams long")


def identify(rows: DataFrame, model, key: list[str], text: str = "text") -> DataFrame:
    """One row per row of `rows`: the columns of `key`, `language`, `probability`, `kept`.
    Optional evidence columns of `rows`: `declared`, `suffix`, `host`, `domain` (strings)."""
    if model is None:
        nothing = [F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("probability"), F.lit(False).alias("kept")]
        return rows.select(*key, *nothing)
    size = len(model[0])
    names = F.array(*[F.lit(n) for n in model[0]])
    lowest = F.array(*[F.lit(float(x) - SLACK) for x in model[2]])
    for c in ("declared", "suffix", "host", "domain"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    seen = text_evidence(rows.select(*key, "declared", "suffix", "host", "domain", text), model, text)
    vote = F.array_position("likelihoods", F.array_max("likelihoods")).cast("int") - 1
    seen = stage(seen.withColumn("vote", vote), "evidence")
    voters = seen.where("vote IS NOT NULL")
    spread = [F.sum(F.when(F.col("vote") == k, 1.0).otherwise(0.0)) for k in range(size)]

    of_all = [x or 0.0 for x in voters.agg(*spread).first()]  # one number per language
    overall = F.array(*[F.lit((x + 1.0) / (sum(of_all) + size)) for x in of_all])

    def likelihood(column: str) -> DataFrame:
        """log P(value | language) for each value of a column, smoothed towards its marginal."""
        counts = voters.where(F.col(column).isNotNull()).groupBy(column).agg(F.array(*spread).alias("of_value"))
        seen_in_all = F.array(*[F.lit(x) for x in of_all])
        share = F.aggregate("of_value", F.lit(0.0), lambda s, x: s + x) / max(1.0, sum(of_all))
        return counts.select(column, F.zip_with("of_value", seen_in_all, lambda x, n: F.log((x + SMOOTHING * share) / (n + SMOOTHING))).alias(f"{column}_likelihoods"))

    domains = voters.where("domain IS NOT NULL").groupBy("domain").agg(F.array(*spread).alias("domain_votes"))
    hosts = voters.where("host IS NOT NULL").groupBy("host").agg(F.array(*spread).alias("host_votes"))
    fused = (
        seen.join(likelihood("declared"), "declared", "left").join(likelihood("suffix"), "suffix", "left")
        .join(domains, "domain", "left").join(hosts, "host", "left")
    )

    def prior(votes: str, up: Column) -> Column:
        """Shares of the languages in `votes` without the row's own vote, smoothed towards `up`."""
        own = F.transform(votes, lambda x, k: x - F.when(F.col("vote") == k, 1.0).otherwise(0.0))
        all_votes = F.aggregate(own, F.lit(SMOOTHING), lambda s, x: s + x)
        return F.coalesce(F.zip_with(own, up, lambda x, u: (x + SMOOTHING * u) / all_votes), up)

    fused = fused.withColumn("of_domain", prior("domain_votes", overall)).withColumn("prior", prior("host_votes", F.col("of_domain")))
    logs = F.transform("prior", lambda x: F.log(x))
    for c in ("likelihoods", "declared_likelihoods", "suffix_likelihoods"):
        logs = F.coalesce(F.zip_with(logs, c, lambda a, b: a + b), logs)
    fused = fused.withColumn("logs", logs).withColumn("most", F.array_max("logs"))
    best = F.array_position("logs", F.col("most")).cast("int") - 1
    chance = 1.0 / F.aggregate("logs", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("most")))
    fused = fused.withColumn("best", best).withColumn("probability", chance)
    own = F.get("mean_likelihoods", F.col("best")) >= F.get(lowest, F.col("best")) - SLACK_OF_ONE / F.sqrt("trigrams")
    kept = F.coalesce((F.col("probability") >= LEAST_PROBABILITY) & own, F.lit(False))
    return fused.select(*key, F.get(names, F.col("best")).alias("language"), "probability", kept.alias("kept"))


def page_evidence(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`pages` with `text`, `declared`, `host`, `domain` (the last two parts that precede no path) and `suffix`."""
    host = F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    host = F.when(F.length(host) > 0, F.regexp_replace(host, r"^www\.", ""))
    declared = F.lower(F.regexp_extract(F.col(html), r"""(?i)<html[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", 1))
    bare = F.regexp_replace(F.col(html), r"(?is)<(script|style|head|nav)\b.*?</\1\s*>|<!--.*?-->", " ")
    bare = F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"&[a-zA-Z]+;|&#\d+;", " ")
    return pages.withColumns({"text": bare, "declared": F.when(F.length(declared) > 0, declared), "host": host}).withColumns(
        {"domain": F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), "suffix": F.regexp_extract("host", r"\.([^.]+)$", 1)}
    ).withColumns({c: F.when(F.length(c) > 0, F.col(c)) for c in ("domain", "suffix")})
