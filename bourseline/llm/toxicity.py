"""Toxicity by a weighted finite-state pattern grammar: matched clauses are scored, not words alone.

A text becomes symbols: a lexicon maps words to classes (insults by four levels, harm, targets,
modals, negations, verbs of report), marks to quotes and clause ends. Five transducers rewrite and
weigh the symbols one after another:

1. negation: an insult or harm within `REACH` words after a negation is denied;
2. reported speech: an insult or harm inside quotes, or after a verb of report in its clause, is told;
3. target: an insult within `REACH` words of a target, on either side, weighs more;
4. threat: modal, harm, target, in this order and near each other, make a threat;
5. weight: each symbol left has its weight.

They are composed into one deterministic transducer (a table of next states and weights), which runs over
the lines that hold an insult or harm. A clause's score is the sum of its weights; a document's
probability is a logistic function of the clauses' scores.

The insults of a corpus are learned: the words whose share among toxic documents differs from that among
others beyond chance (likelihood ratio, corrected for the number of words tested), at the level of their
log odds. They and the logistic function come from at most `FIT_ROWS` labelled documents of each label,
those with the lowest hashes of their ids, and at most `FIT_WORDS` distinct words of any (those with
the lowest hashes, drawn from its whole text). Near copies among them (32 minima over five-word shingles,
in bands of four) count once for each label. Scoring reads every word of every text.

Cases: a null text is an empty text; a text without a match has the probability of no match; rows with
null or repeated ids are scored each for itself; of an id with several texts the fit takes the one with the
lowest hash, and an id with both labels has none; without labels of both kinds the built-in words and a fixed function are
used; an empty table gives an empty result; only the named columns are read, so extra columns cannot
clash; lines above `PIECE` characters are read in pieces at word ends, and the state goes on.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseline.llm.byte_bpe import sliced
from bourseline.llm.minhash import shingle_hashes
from bourseline.sources.storage import stage

FIT_ROWS, FIT_WORDS = 2000, 8192
MOST_WORDS = 5000  # learned insults: those with the highest likelihood ratio
LONGEST_WORD = 40  # characters of a word that can be learned
REACH = 3
PIECE = 1 << 18
TOKEN = re.compile(r"[^\W\d_]+|[.!?;…]+|[\"“”„«»]")
WORD = re.compile(r"[^\W\d_]+")

# Symbols.
OTHER, STOP, QUOTE, OPEN, CLOSE, TARGET, NEGATION, MODAL, REPORT, HARM, THREAT, LINE = range(12)
INSULT = [12, 13, 14, 15]  # by level
TOLD = [16, 17, 18, 19]
SYMBOLS = 20
LEVELS = (1.0, 2.0, 3.0, 4.0)  # log odds from which a word belongs to the level, and the level's weight
TOLD_SHARE, AIMED, THREATENED = 0.3, 0.5, 4.0

# Words of the built-in lexicon, in English, German, French and Spanish.
BUILT_IN = {
    INSULT[2]: """idiot idiots moron morons loser losers scum stupid pathetic worthless disgusting trash clown clowns imbecile imbeciles
        dumbass scumbag bastard bastards idioten trottel abschaum dummkopf versager arschloch idiote idiotes imbécile crétin ordure salaud
        idiotas imbécil estúpido estúpida basura cabrón""",
    HARM: "kill hurt beat destroy burn shoot stab töten umbringen verprügeln zerstören tuer frapper détruire brûler matar golpear destruir quemar",
    TARGET: "you your he she they him them his her their people du dich dir ihr euch er sie ihn ihnen tu te toi vous ils elles lui leur tú ti usted ustedes ellos ellas él",
    MODAL: "will gonna going shall ll werde werden vais va allons voy vamos va",
    NEGATION: "not never no nobody isn don doesn didn won aren wasn weren cannot nicht kein keine keinen nie niemals pas jamais aucun ne nunca jamás ningún",
    REPORT: "said says say called calls wrote writes claimed claims sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó",
}
MARKS = {'"': QUOTE, "“": OPEN, "„": OPEN, "«": OPEN, "”": CLOSE, "»": CLOSE}
START_OF_FIXED = (-3.0, 1.0, 0.5, 0.5)  # the function used without labels

State = tuple
Step = Callable[[State, int], tuple[State, int, float]]


@dataclass
class Transducer:
    """A deterministic machine: from a state and a symbol to the next state, a symbol and a weight."""

    start: State
    step: Step

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one writes, the other reads; weights add up."""

        def step(state: State, symbol: int) -> tuple[State, int, float]:
            own, between, first = self.step(state[0], symbol)
            its, out, second = other.step(state[1], between)
            return (own, its), out, first + second

        return Transducer((self.start, other.start), step)

    def compiled(self) -> tuple[list[list[int]], list[list[float]]]:
        """Tables of next states and weights by state and symbol; state 0 is the start."""
        known, pending = {self.start: 0}, [self.start]
        following: list[list[int]] = []
        weights: list[list[float]] = []
        for state in pending:
            steps = [self.step(state, symbol) for symbol in range(SYMBOLS)]
            for to, _, _ in steps:
                if to not in known:
                    known[to] = len(known)
                    pending.append(to)
            following.append([known[to] for to, _, _ in steps])
            weights.append([w for _, _, w in steps])
        return following, weights


def negation() -> Transducer:
    def step(state: State, symbol: int) -> tuple[State, int, float]:
        left = state[0]
        if symbol in (STOP, LINE):
            return (0,), symbol, 0.0
        if symbol == NEGATION:
            return (REACH,), symbol, 0.0
        denied = left > 0 and (symbol in INSULT or symbol == HARM)
        return (max(0, left - 1),), OTHER if denied else symbol, 0.0

    return Transducer((0,), step)


def reported() -> Transducer:
    def step(state: State, symbol: int) -> tuple[State, int, float]:
        quoted, said = state
        if symbol == LINE:
            return (False, False), symbol, 0.0
        if symbol == STOP:
            return (quoted, False), symbol, 0.0
        if symbol in (QUOTE, OPEN, CLOSE):
            return ((not quoted) if symbol == QUOTE else symbol == OPEN, said), OTHER, 0.0
        if symbol == REPORT:
            return (quoted, True), OTHER, 0.0
        if quoted or said:
            if symbol in INSULT:
                return state, TOLD[INSULT.index(symbol)], 0.0
            if symbol == HARM:
                return state, OTHER, 0.0
        return state, symbol, 0.0

    return Transducer((False, False), step)


def targeted() -> Transducer:
    """Words left in which a target, or an insult, still reaches the other."""

    def step(state: State, symbol: int) -> tuple[State, int, float]:
        target, insult = state
        if symbol in (STOP, LINE):
            return (0, 0), symbol, 0.0
        if symbol == TARGET:
            return (REACH, 0), symbol, AIMED if insult else 0.0
        if symbol in INSULT:
            return (max(0, target - 1), 0 if target else REACH), symbol, AIMED if target else 0.0
        return (max(0, target - 1), max(0, insult - 1)), symbol, 0.0

    return Transducer((0, 0), step)


def threatened() -> Transducer:
    def step(state: State, symbol: int) -> tuple[State, int, float]:
        part, left = state
        if symbol in (STOP, LINE, NEGATION):
            return (0, 0), symbol, 0.0
        if symbol == MODAL:
            return (1, REACH), symbol, 0.0
        if symbol == HARM and part == 1:
            return (2, REACH), symbol, 0.0
        if symbol == TARGET and part == 2:
            return (0, 0), THREAT, 0.0
        return ((part, left - 1) if left > 1 else (0, 0)), symbol, 0.0

    return Transducer((0, 0), step)


def weighed() -> Transducer:
    weight = dict(zip(INSULT, LEVELS)) | {t: TOLD_SHARE * w for t, w in zip(TOLD, LEVELS)} | {THREAT: THREATENED}
    return Transducer((), lambda state, symbol: (state, symbol, weight.get(symbol, 0.0)))


def grammar() -> Transducer:
    return negation().then(reported()).then(targeted()).then(threatened()).then(weighed())


FOLLOWING, WEIGHTS = grammar().compiled()
TRIGGER = re.compile(b"[" + bytes([HARM, *INSULT]) + b"]")
ENDS = (STOP, LINE)


@dataclass
class Model:
    insults: dict[str, int] = field(default_factory=dict)  # learned words and their symbols
    function: tuple[float, ...] = START_OF_FIXED  # intercept and a factor for each feature

    def lexicon(self) -> dict[str, int]:
        words = {w: symbol for symbol, own in BUILT_IN.items() for w in own.split()}
        return MARKS | words | self.insults


def lowered(text: str) -> str:
    """In lower case, as long as before."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _pieces(line: str) -> Iterator[tuple[int, str]]:
    at = 0
    while len(line) - at > PIECE:
        end = next((m.start() for m in re.finditer(r"[\W\d_]", line[at + PIECE : at + 2 * PIECE])), PIECE)
        yield at, line[at : at + PIECE + end]
        at += PIECE + end
    yield at, line[at:]


def clauses(text: str, lexicon: dict[str, int]) -> Iterator[tuple[int, int, float]]:
    """(start, end, score) of each clause that has a weight, in code points."""
    kinds = lexicon.get
    begin_of_line = 0
    for line in lowered(text).split("\n"):
        state, score, begin, end = 0, 0.0, None, 0
        alone = len(line) <= PIECE
        for at, piece in [(0, line)] if alone else _pieces(line):
            tokens = TOKEN.findall(piece)
            symbols = bytes(map(kinds, tokens, itertools.repeat(OTHER)))
            if alone and not TRIGGER.search(symbols):
                break
            for m in TOKEN.finditer(piece):
                token = m.group()
                symbol = STOP if token[0] in ".!?;…" else kinds(token, OTHER)
                score += WEIGHTS[state][symbol]
                state = FOLLOWING[state][symbol]
                if symbol == STOP:
                    if score:
                        yield begin_of_line + begin, begin_of_line + end, score
                    score, begin = 0.0, None
                else:
                    begin = at + m.start() if begin is None else begin
                    end = at + m.end()
        if score:
            yield begin_of_line + begin, begin_of_line + end, score
        begin_of_line += len(line) + 1


def features(found: list[tuple[int, int, float]], length: int) -> list[float]:
    """Of a document: the logarithm of its clauses' sum, the weight of its worst clause, and of the sum by length."""
    total = sum(f[2] for f in found)
    return [math.log1p(total), min(8.0, max((f[2] for f in found), default=0.0)), math.log1p(1000 * total / (length + 200))]


def _texts(part: pa.RecordBatch, column: int) -> list[str]:
    return [(t or b"").decode("utf-8", "replace") for t in part.column(column).cast(pa.binary()).to_pylist()]


def _minima() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return rng.integers(0, 2**63, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, 32, dtype=np.uint64)


def sampled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """At most `rows` labelled documents of each label, stored: `h` (hash of the key), `y` and `text`."""
    own = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias("_y"), F.max(label).alias("_z"))
    own = own.where("_y = _z").select(key, "_y")
    some = [own.where(F.col("_y") == y).orderBy(F.xxhash64(key), key).limit(rows) for y in (0, 1)]
    # At most twice `rows` ids are sent; of the texts only theirs move.
    found = docs.select(key, text).join(F.broadcast(some[0].unionByName(some[1])), key)
    first = found.groupBy(key, "_y").agg(F.min(F.struct(F.xxhash64(text).alias("of"), F.col(text).alias("text"))).alias("first"))
    return stage(first.select(F.xxhash64(key).alias("h"), F.col("_y").alias("y"), F.col("first")["text"].alias("text")), "labelled")


def sketched(sample: DataFrame) -> DataFrame:
    """`h`, `y`, `bands` of near copies and `words` (distinct) of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, added = _minima()
        for batch in batches:
            for part in sliced(batch, 2, 1 << 18):
                bands, words = [], []
                for t in _texts(part, 2):
                    hashes = shingle_hashes(t.encode("utf-8"), 5)
                    least = np.full(32, np.iinfo(np.uint64).max, dtype=np.uint64)
                    for at in range(0, len(hashes), 8192):
                        np.minimum(least, ((hashes[at : at + 8192, None] * factor + added) >> np.uint64(8)).min(axis=0), out=least)
                    bands.append([hash(tuple(least[k : k + 4].tolist())) for k in range(0, 32, 4)] if len(hashes) else [])
                    own = {w for _, piece in _pieces(lowered(t)) for w in WORD.findall(piece) if len(w) <= LONGEST_WORD}
                    words.append(sorted(own) if len(own) <= FIT_WORDS else sorted(sorted(own, key=_order)[:FIT_WORDS]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(bands, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.string()))], names=["h", "y", "bands", "words"])

    return sample.select("h", "y", "text").mapInArrow(run, "h long, y int, bands array<long>, words array<string>")


def _order(word: str) -> int:
    import zlib

    return zlib.crc32(word.encode("utf-8", "replace"))


def _representatives(bands: list[list[int]], labels: list[int]) -> list[int]:
    """One of each group of near copies and label."""
    parent = list(range(len(bands)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    seen: dict[tuple[int, int], int] = {}
    for i, own in enumerate(bands):
        for band in enumerate(own):
            parent[root(i)] = root(seen.setdefault(band, i))
    first: dict[tuple[int, int], int] = {}
    for i, y in enumerate(labels):
        first.setdefault((root(i), y), i)
    return sorted(first.values())


def _likelihood_ratio(hits: int, others: int, n_hits: int, n_others: int) -> float:
    """Twice the logarithm of how much better two shares explain the counts than one."""
    share = (hits + others) / (n_hits + n_others)
    out = 0.0
    for k, n in ((hits, n_hits), (others, n_others)):
        for count, p in ((k, share), (n - k, 1 - share)):
            out += 2 * count * math.log(count / (n * p)) if count else 0.0
    return out


def learned(words: list[list[str]], labels: list[int]) -> dict[str, int]:
    """Insults among the words of the documents (lists of distinct words), by level of their log odds."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for own, y in zip(words, labels):
        counts[y].update(own)
    n_toxic = sum(labels)
    n_clean = len(labels) - n_toxic
    tested = sum(1 for w, t in counts[1].items() if t + counts[0][w] >= 3)
    bar = 2 * math.log(max(2, tested))
    found = []
    for w, t in counts[1].items():
        odds = math.log((t + 0.5) / (n_toxic + 1)) - math.log((counts[0][w] + 0.5) / (n_clean + 1))
        if t >= 2 and odds >= LEVELS[0]:
            ratio = _likelihood_ratio(t, counts[0][w], n_toxic, n_clean)
            if ratio > bar:
                found.append((-ratio, w, INSULT[sum(odds >= level for level in LEVELS) - 1]))
    return {w: symbol for _, w, symbol in sorted(found)[:MOST_WORDS]}


def _logistic(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, ...]:
    """Intercept and factors by Newton's steps with a small penalty; the intercept is moved to the share of the labels."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    penalty = np.diag([0.0, *[0.1] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(b)), x.T @ (y - p) - penalty @ b)
        b += np.clip(step, -5, 5)
    own = float(np.mean(y))
    b[0] += math.log(prior / (1 - prior)) - math.log(own / (1 - own))
    return tuple(b.tolist())


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = FIT_ROWS) -> Model:
    """Learned insults and the function of the features."""
    sample = sampled(docs, labels, key, text, label, rows)
    data = sorted(sketched(sample).collect(), key=lambda r: (r["h"], r["y"], r["bands"], r["words"]))
    ys = [r["y"] for r in data]
    chosen = _representatives([r["bands"] for r in data], ys)
    words, ys = [data[i]["words"] for i in chosen], [ys[i] for i in chosen]
    if len(set(ys)) < 2:
        return Model()
    model = Model(learned(words, ys))
    # Each half is weighed by the insults of the other, so that the function meets words it did not choose.
    halves = [Model(learned(words[k::2], ys[k::2])) if len(set(ys[k::2])) == 2 else model for k in (1, 0)]
    codes = [h.lexicon() for h in halves]
    half_of = {(data[i]["h"], data[i]["y"]): n % 2 for n, i in enumerate(chosen)}
    counted = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(label).agg(F.countDistinct(key).alias("n")).collect()
    n = {r[label]: r["n"] for r in counted}
    some = docs.sparkSession.createDataFrame([(h, y, half) for (h, y), half in half_of.items()], "h long, y int, half int")
    rows_of = sample.join(F.broadcast(some), ["h", "y"]).select("y", "half", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, 2):
                halves_of = part.column(1).to_pylist()
                out = [features(list(clauses(t, codes[k])), len(t)) for t, k in zip(_texts(part, 2), halves_of)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.list_(pa.float64()))], names=["y", "x"])

    fitted = sorted((r["y"], r["x"]) for r in rows_of.mapInArrow(run, "y int, x array<double>").collect())
    y = np.array([r[0] for r in fitted], dtype=np.float64)
    if len(set(y)) == 2:
        model.function = _logistic(np.array([r[1] for r in fitted]), y, n[1] / (n[0] + n[1]))
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `key`, `score` (the probability of label 1) and `clauses`: the spans
    (`start`, `end` in code points) and weights of the clauses that the grammar matched."""
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("weight", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = model.lexicon()
        for batch in batches:
            for part in sliced(batch, 1):
                scores, spans = [], []
                for t in _texts(part, 1):
                    found = list(clauses(t, lexicon))
                    logit = model.function[0] + sum(a * b for a, b in zip(model.function[1:], features(found, len(t))))
                    scores.append(1 / (1 + math.exp(-max(-500.0, min(500.0, logit)))))
                    spans.append([dict(zip(("start", "end", "weight"), f)) for f in found])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))], names=[key, "score", "clauses"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double, clauses array<struct<start:int,end:int,weight:double>>")
