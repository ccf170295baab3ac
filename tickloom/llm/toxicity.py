"""Toxicity by a weighted finite-state pattern grammar, with words and weights learned from labels.

A word becomes a symbol: target, negation, reported speech, intent, threat, or insult of one of three strengths. Five
small transducers are composed into one machine that runs over a clause's symbols: negation rewrites insults that follow
within three words, threat turns a threat word after an intent into a threat, target and reported speech weigh
the clause up and down, and insult aims insults: those after a target (AIM words), after an aimed one, or with a target soon
behind them (BACK words). A clause matches if it has a threat or an aimed insult, and scores these times its weight. Insults that
nothing aims are a class of their own, with features and learned weights of their own; threat words without intent count
for nothing. A document's score is a logistic function of its clauses' scores.

Insults are a fixed list and, beyond it, words and word beginnings that training texts labelled toxic have far more often
than the others; those and the logistic weights are learned from at most FIT_ROWS labelled rows. Only texts are inputs of
a score: null and empty ones score as texts without a match. Rows whose crc32 of the id, as text, is 0 modulo 5 are held out;
null ids are neither held out nor learned from. Without usable labels the fixed list and fixed weights score. Rows with
repeated ids are rows of their own; an empty table gives no rows; labels' other columns aren't read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C
from .pretokens import Memory

#: Labelled rows that are learned from, at most (about; they are chosen by a hash of their ids), and learned entries at most.
FIT_ROWS, ENTRIES = 20_000, 4000
#: A learned entry is in so many toxic training texts at least, and that share of them, and so many times likelier there.
LEAST, SHARE, RATIO = 4, 0.01, 12.0
#: Word beginnings that are learned have so many letters.
STEM = range(4, 11)
FOLDS = 5

# The grammar's words.
TARGETS = "you your yours yourself u ur he him she her they them du dich dir euch ihr sie tu toi te vous ton ta tes tú ti usted ustedes ellos ella él".split()
NEGATIONS = "not no never isn't aren't wasn't don't doesn't didn't nicht kein keine keiner nie pas jamais aucun aucune ne nunca ningún ninguna tampoco".split()
REPORTS = "said says say wrote writes claimed claims quoted quotes called reported according sagte sagt schrieb behauptet nannte dit disait écrit selon dijo dice escribió según".split()
INTENTS = "will shall gonna going i'll we'll must should werde werden wirst vais va allons voy vamos".split()
THREATS = "kill hurt destroy beat burn shoot stab hang strangle crush murder töten umbringen verletzen tuer frapper détruire brûler matar golpear destruir quemar".split()
INSULTS = (
    "idiot idiots moron morons stupid loser losers scum trash clown clowns worthless pathetic disgusting imbecile dumb fool filth vermin parasite "
    "dumm dummkopf abschaum widerlich erbärmlich wertlos versager trottel imbécile crétin minable ordure dégoûtant débile estúpido imbécil basura asqueroso patético inútil payaso"
).split()

#: What is read (O to I3) and put out besides: negated insults, threats, aimed insults, targets that aim an insult before them.
O, T, N, R, W, K, I1, I2, I3, I0, THREAT, J1, J2, J3, A1, A2, A3 = range(17)  # noqa: E741
#: Part of an insult's strength that counts if nothing aims it.
LONE = 0.5
AIMED = (0.5, 1.0, 1.5)
STRENGTH = {I0: 0.1, THREAT: 2.0} | {I1 + i: LONE * x for i, x in enumerate(AIMED)} | {J1 + i: x for i, x in enumerate(AIMED)}
STRENGTH |= {A1 + i: x - LONE * x for i, x in enumerate(AIMED)}
END = 16
#: A negation reaches so many words; a target aims insults so many words on, an aimed insult and a target behind so many.
REACH, AIM, BACK = 3, 4, 2
#: Logarithms of a clause's weight.
TARGETED, REPORTED = math.log(1.5), math.log(0.4)
MARKS = ".,;:!?\"'()[]{}*#$%&|-_/\\<>«»“”„¡¿…"
STOPS = frozenset(".;:!?…")


class Machine:
    """A deterministic weighted transducer: step(state, symbol) is (state, symbol out, logarithm of the weight)."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def then(self, other: Machine) -> Machine:
        """The composition: what this machine puts out is what the other reads; weights multiply."""

        def step(state, symbol):
            a, out, x = self.step(state[0], symbol)
            b, out, y = other.step(state[1], out)
            return (a, b), out, x + y

        return Machine((self.start, other.start), step)

    def table(self, symbols: range) -> list[list[tuple[int, int, float]]]:
        """All states that can be reached, numbered from the start."""
        number, rows, todo = {self.start: 0}, [], [self.start]
        while todo:
            state = todo.pop(0)
            row = []
            for s in symbols:
                to, out, weight = self.step(state, s)
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                row.append((number[to], out, weight))
            rows.append(row)
        return rows


def _negation(left, s):
    if s == N:
        return REACH, s, 0.0
    return max(0, left - 1), I0 if left and s in (I1, I2, I3) else s, 0.0


def _threat(intent, s):
    return intent or s == W, THREAT if s == K and intent else s, 0.0


def _once(symbol: int, weight: float):
    def step(seen, s):
        return seen or s == symbol, s, weight if s == symbol and not seen else 0.0

    return step


def _insult(state, s):
    """state: words that a target or an aimed insult still reaches; the last insult that isn't aimed, and words until it is forgotten."""
    aim, last, left = state
    if s == T:
        return (AIM, 0, 0), A1 + last - I1 if left else s, 0.0
    if s in (I1, I2, I3):
        return ((max(aim - 1, BACK), 0, 0), J1 + s - I1, 0.0) if aim else ((0, s, BACK), s, 0.0)
    return (max(0, aim - 1), last if left > 1 else 0, max(0, left - 1)), s, 0.0


GRAMMAR = (
    Machine(0, _negation)
    .then(Machine(False, _threat))
    .then(Machine(False, _once(T, TARGETED)))
    .then(Machine(False, _once(R, REPORTED)))
    .then(Machine((0, 0, 0), _insult))
    .table(range(K + 4))
)


@dataclass
class Model:
    """words and stems: symbols of learned words and of words that begin so; weights: of the features, the constant first."""

    words: dict[str, int] = field(default_factory=dict)
    stems: dict[str, int] = field(default_factory=dict)
    weights: tuple[float, ...] = (-4.0, 2.0, 0.5, 1.0, 0.5, 0.5, 0.2)

    def symbol(self, token: str) -> int:
        word = token.strip(MARKS)
        end = END if token[-1] in STOPS else 0
        return self._of(word) | end

    def _of(self, word: str) -> int:
        found = self.words.get(word)
        if found is None:
            found = FIXED.get(word, O)
            if found == O:
                for n in STEM:
                    if n > len(word):
                        break
                    hit = self.stems.get(word[:n])
                    if hit:
                        return hit
        return found


FIXED = {w: s for s, words in ((T, TARGETS), (N, NEGATIONS), (R, REPORTS), (W, INTENTS), (K, THREATS), (I1, INSULTS)) for w in words}
TOXIC = [K, I1, I2, I3]
_TOXIC_BYTES = [bytes([s | e]) for s in TOXIC for e in (0, END)]
#: A clause: symbols up to one that ends it.
_clauses = re.compile(rb"[\x00-\x0f]*[\x10-\x1f]|[\x00-\x0f]+").findall


#: Features of a text.
FEATURES = ("matched", "best", "clauses", "matches", "lone", "lone_words")


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.symbols = Memory(model.symbol)

    def features(self, text: str) -> tuple[float, ...]:
        """FEATURES: matching clauses' scores in sum (logarithm), the largest score of any clause, the number of clauses that match,
        matches per hundred words; the scores of clauses that don't match, and their insults per hundred words."""
        get = self.symbols.young.__getitem__
        best, n = 0.0, 0
        sums, clauses, words = [0.0, 0.0], [0, 0], [0, 0]
        for line in text.lower().split("\n"):
            codes = bytes(map(get, line.split()))
            n += len(codes)
            if not any(b in codes for b in _TOXIC_BYTES):
                continue
            for clause in _clauses(codes):
                base, weight, matches, lone = 0.0, 0.0, 0, 0
                state = 0
                for c in clause:
                    state, out, w = GRAMMAR[state][c & 15]
                    weight += w
                    if out >= I1:
                        base += STRENGTH[out]
                        matches += out >= THREAT
                        lone += out < THREAT
                if base:
                    score, kind = base * math.exp(weight), 0 if matches else 1
                    best = max(best, score)
                    sums[kind] += score
                    clauses[kind] += 1
                    words[kind] += matches or lone
        share = 100 / max(n, 20)
        return math.log1p(sums[0]), best, math.log1p(clauses[0]), math.log1p(share * words[0]), math.log1p(sums[1]), math.log1p(share * words[1])

    def score(self, text: str) -> float:
        x = self.features(text)
        z = self.model.weights[0] + sum(w * v for w, v in zip(self.model.weights[1:], x, strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic: at most about FIT_ROWS labelled texts of other folds, exact copies once. The chosen labels are broadcast."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    n = usable.count()
    part = 1 << 20
    share = min(part, -(-FIT_ROWS * part // max(n, 1)))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(part)) < share).limit(2 * FIT_ROWS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("same")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def learn_words(rows: DataFrame, positives: int, negatives: int) -> tuple[dict[str, int], dict[str, int]]:
    """Words and word beginnings that are RATIO times likelier in toxic texts; only the chosen entries come to the driver."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, marks = [], []
            for text, y in zip(batch.column(0), batch.column(1)):
                own = {t.strip(MARKS) for t in text.as_py().lower().split()}
                forms = {f"{w}$" for w in own if len(w) > 2} | {w[:n] for w in own for n in STEM if n <= len(w)}
                out += forms
                marks += [y.as_py()] * len(forms)
                if len(out) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(marks, pa.int32())], ["form", "y"])
                    out, marks = [], []
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(marks, pa.int32())], ["form", "y"])

    counts = rows.mapInArrow(words, "form string, y int").groupBy("form").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
    ratio = (F.col("p") / positives) / ((F.col("n") + 0.5) / negatives)
    found = counts.where((F.col("p") >= max(LEAST, SHARE * positives)) & (ratio >= RATIO)).select("form", "p", "n", ratio.alias("ratio"))
    best = found.orderBy(F.desc("p"), "form").limit(ENTRIES).collect()
    entries = {r.form: r for r in best}
    words_out, stems = {}, {}
    for form, r in sorted(entries.items(), key=lambda e: len(e[0])):
        level = I3 if r.ratio >= 4 * RATIO and r.n <= 0.02 * r.p else I2
        if form.endswith("$"):
            if not any(form[:n] in stems for n in STEM):
                words_out[form[:-1]] = level
        elif not any(form[:n] in stems for n in STEM if n < len(form)):
            stems[form] = level
    return words_out, stems


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method with a ridge on all but the constant, in units of each feature's deviation, so that a feature's scale doesn't
    matter; a step that would make the fit worse is halved."""
    spread = x.var(axis=0)
    x = np.hstack([np.ones((len(x), 1)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6, *np.maximum(ridge * spread, 1e-6)])

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - y @ z + w @ penalty @ w / 2

    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (y - p) - penalty @ w)
        now = loss(w)
        while np.abs(step).max() > 1e-8 and not loss(w + step) <= now + 1e-9:
            step /= 2
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows = C.spool(training(docs, labels), "labelled")
    counts = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    positives, negatives = counts.get(1, 0), counts.get(0, 0)
    if positives < LEAST or negatives < LEAST:
        return Model()
    words, stems = learn_words(rows, positives, negatives)
    model = Model(words, stems)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.release()
        scorer = Scorer(model)
        for batch in batches:
            got = [(*scorer.features(t.as_py()), float(y.as_py())) for t, y in zip(batch.column(0), batch.column(1))]
            yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], pa.float64()) for i in range(len(FEATURES) + 1)], [*FEATURES, "y"])

    sample = np.array([tuple(r) for r in rows.mapInArrow(measured, ", ".join(f"{c} double" for c in [*FEATURES, "y"])).collect()])
    model.weights = tuple(logistic(sample[:, :-1], sample[:, -1]).tolist())
    return model


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted: a row per document; texts aren't shuffled."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), C.text_of().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.release()
        scorer = Scorer(model)
        for batch in batches:
            scores = [scorer.score(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """docs, all columns, without those that score 0.5 or more: one pass, no join."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.release()
        scorer = Scorer(model)
        for batch in C.slices(batches):
            at = batch.schema.get_field_index("text")
            yield batch.filter(pa.array([scorer.score(t.as_py() or "") < 0.5 for t in batch.column(at)], pa.bool_()))

    return docs.select(*names).mapInArrow(run, docs.schema)
