"""Toxicity by a weighted finite-state pattern grammar over clauses.

Two transducers are composed. The lexical one maps words to symbols: INSULT (with a weight learned from labels, by whole
word or by stem), THREAT, TARGET, NEGATION, REPORT, and OTHER. The grammar one reads a clause's symbols and emits a
weighted match for each insult or threat, in a way that depends on what it has read: plain, aimed at a target, negated, or
reported speech. A document's matches, summed by kind, go through a logistic function learned from labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm._spark import drop_stored, filter_of, map_arrow, passes, slot, stored
from kinweave.llm._text import ALNUM, U64, Words, lowered, mix, prefix_sums, signed, span_hash, word_chunks

#: Labelled rows of either class that the model is fitted on, about (a hash picks them); half give the lexicon, half the weights.
SAMPLE = 6000
#: Stem lengths in bytes, entries of the learned lexicon, least toxic documents with an entry, least log odds.
STEMS, ENTRIES, LEAST_DOCS, LEAST_ODDS = (4, 5, 6), 4096, 4, 2.0
#: Words that a negation reaches over.
NEGATION_REACH = 3

#: Symbols of the lexical transducer.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
LEXICON = {
    TARGET: "you your yours yourself he him she her they them these those this people du dich dir ihr euch sie tu toi vous te ils elles usted ustedes ellos",
    NEGATION: "not no never nor neither without isn aren wasn weren don doesn didn nicht kein keine nie niemals pas jamais aucun nunca ni tampoco sin",
    REPORT: "said says wrote writes called calls claimed quoted quote reported according sagte schrieb nannte laut dit disait appelle selon dijo escribió llamó según",
    THREAT: "kill hurt destroy attack murder beat burn töten umbringen verletzen tuer frapper détruire matar golpear destruir",
}
#: States of the grammar transducer are (negation left to run, in reported speech, target seen); kinds of its matches:
PLAIN, AIMED, NEGATED, REPORTED, THREATENING = range(5)
KINDS = 5


def grammar(symbols: list[tuple[int, float]]) -> np.ndarray:
    """Matched weight by kind of one clause, from its (symbol, weight) pairs in order."""
    out = np.zeros(KINDS)
    reach, reported, aimed = 0, False, any(s == TARGET for s, _ in symbols)
    for symbol, weight in symbols:
        if symbol == NEGATION:
            reach = NEGATION_REACH + 1
        elif symbol == REPORT:
            reported = True
        elif symbol == INSULT:
            out[NEGATED if reach else REPORTED if reported else AIMED if aimed else PLAIN] += weight
        elif symbol == THREAT and aimed and not reach:
            out[REPORTED if reported else THREATENING] += 1.0
        reach = max(0, reach - 1)
    return out


class Lexical:
    """The lexical transducer: hashes of words and of stems to symbols and weights."""

    def __init__(self, entries: dict[int, float]):
        fixed = {}
        for symbol, words in LEXICON.items():
            raw = " ".join(words.split()).encode()
            for h in Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM).hash.tolist():
                fixed[int(mix(np.array([h], U64), 20)[0])] = (symbol, 0.0)
        for h, w in entries.items():
            fixed.setdefault(h, (INSULT, w))
        self.keys = np.array(sorted(fixed), dtype=U64)
        self.symbol = np.array([fixed[int(k)][0] for k in self.keys], dtype=np.int64)
        self.weight = np.array([fixed[int(k)][1] for k in self.keys])
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.keys & U64((1 << 20) - 1)).astype(np.int64)] = True

    def read(self, forms: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, symbol, weight) of the words that are not OTHER: the whole word's entry, else its heaviest stem's."""
        at, sym, wt = [], [], []
        for order, h in enumerate(forms):
            some = np.flatnonzero(self.maybe[(h & U64((1 << 20) - 1)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.keys, h[some]), max(len(self.keys) - 1, 0))
            ok = self.keys[place] == h[some] if len(self.keys) else np.zeros(len(some), bool)
            some, place = some[ok], place[ok]
            if order:  # stems have insults only
                some, place = some[self.symbol[place] == INSULT], place[self.symbol[place] == INSULT]
            at.append(some)
            sym.append(self.symbol[place])
            wt.append(self.weight[place])
        where, symbol, weight = np.concatenate(at), np.concatenate(sym), np.concatenate(wt)
        order = np.lexsort((-weight, symbol == INSULT, where))  # fixed symbols win over learned ones
        where, symbol, weight = where[order], symbol[order], weight[order]
        first = np.ones(len(where), dtype=bool)
        first[1:] = where[1:] != where[:-1]
        return where[first], symbol[first], weight[first]


def word_forms(words: Words) -> list[np.ndarray]:
    """Hashes of each word and of its stems; a word without a stem of some length has its own hash for it, salted."""
    sums = prefix_sums(lowered(words.data))
    size = words.end - words.start
    out = [mix(words.hash, 20)]
    for n in STEMS:
        stem = span_hash(sums, words.start, np.minimum(words.start + n, words.end), 30 + n)
        out.append(np.where(size >= n, stem, U64(0)))
    return out


def _clauses(words: Words) -> np.ndarray:
    """The clause number of each word; clauses end at . ! ? ; : , and line ends."""
    stop = np.zeros(256, dtype=bool)
    stop[[ord(c) for c in ".!?;:,\n"]] = True
    return np.cumsum(stop[words.data])[words.start] if len(words.start) else np.zeros(0, np.int64)


def features(words: Words, lexical: Lexical) -> np.ndarray:
    """A row per document: log of 1 + matched weight of each kind, of their sum, and of the sum per hundred words."""
    n = len(words)
    kinds = np.zeros((n, KINDS))
    where, symbol, weight = lexical.read(word_forms(words))
    doc = np.searchsorted(words.first, where, side="right") - 1
    clause = _clauses(words)[where]
    hot = np.unique((doc * (len(words.data) + 1) + clause)[(symbol == INSULT) | (symbol == THREAT)])
    group = doc * (len(words.data) + 1) + clause
    own = np.isin(group, hot)
    where, symbol, weight, doc, group = where[own], symbol[own], weight[own], doc[own], group[own]
    for idx in np.split(np.arange(len(group)), np.flatnonzero(np.diff(group)) + 1) if len(group) else []:
        clause_symbols, last = [], None
        for i in idx.tolist():
            if last is not None:  # words between count for the reach of a negation
                clause_symbols += [(OTHER, 0.0)] * min(NEGATION_REACH + 1, int(where[i]) - last - 1)
            clause_symbols.append((int(symbol[i]), float(weight[i])))
            last = int(where[i])
        kinds[doc[idx[0]]] += grammar(clause_symbols)
    total = kinds.sum(axis=1, keepdims=True)
    count = np.maximum(np.diff(words.first), 1)[:, None]
    return np.log1p(np.hstack([kinds, total, 100 * total / count]))


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, ridge: float = 0.05, steps: int = 60) -> np.ndarray:
    """Weights and, last, intercept of a ridge logistic regression in which a row counts ``times``, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (times * (p - y)) + penalty * beta
        step = np.linalg.solve((x * (times * p * (1 - p))[:, None]).T @ x + np.diag(penalty), grad)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


class Model:
    """The composed grammar: lexicon entries (hash to weight) and the logistic weights."""

    def __init__(self, entries: dict[int, float], beta: np.ndarray):
        self.entries, self.beta = entries, beta

    def scorer(self):
        lexical = Lexical(self.entries)

        def score(words: Words) -> np.ndarray:
            x = features(words, lexical)
            return 1 / (1 + np.exp(-np.clip(x @ self.beta[:-1] + self.beta[-1], -30, 30)))

        return score


def _lexicon_counts(docs: DataFrame) -> DataFrame:
    """(form, pos, neg): documents of either label with a word or stem, counted in each batch before the shuffle."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        toxic = batch["toxic"].to_numpy(zero_copy_only=False)
        for lo, hi, words in word_chunks(batch["text"], ALNUM):
            doc = np.repeat(np.arange(hi - lo), np.diff(words.first)).astype(U64)
            every = []
            for h in word_forms(words):
                pairs = np.unique(np.stack([h, doc], axis=1)[h != 0], axis=0) if len(h) else np.zeros((0, 2), U64)
                every.append(pairs)
            pairs = np.concatenate(every)
            y = toxic[lo:hi][pairs[:, 1].astype(np.int64)].astype(np.int64)
            form, which = np.unique(pairs[:, 0], return_inverse=True)
            pos = np.bincount(which, weights=y, minlength=len(form)).astype(np.int64)
            neg = np.bincount(which, minlength=len(form)).astype(np.int64) - pos
            yield pa.RecordBatch.from_arrays([pa.array(signed(form)), pa.array(pos), pa.array(neg)], ["form", "pos", "neg"])

    return map_arrow(docs.select("text", "toxic"), run, "form long, pos long, neg long").groupBy("form").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column | None = None, sample: int = SAMPLE, entries: int = ENTRIES) -> Model:
    """A model of ``labels`` (doc_id, toxic) and the texts of ``docs`` (doc_id, text).

    ``train`` is a condition on doc_id. About ``sample`` rows of either class are taken, by a hash of doc_id; that bounds
    what is joined and what reaches the driver (``entries`` lexicon entries and a few numbers a row). For the weights a row
    counts as many times as its class is larger than what was taken of it, so the cut is that of all rows. Rows with a
    null label, id or text are left out. Without rows of both classes nothing is toxic.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    rows = rows.where(train) if train is not None else rows
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Model({}, np.array([0.0] * (KINDS + 2) + [-5.0]))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_003)) / 1_000_003.0
    chosen = rows.where(draw < F.when(F.col("toxic") == 1, sample / sizes[1]).otherwise(sample / sizes[0]))
    bitmap = filter_of(chosen, slot("doc_id"))

    def pick(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(passes(bitmap, batch["place"].to_numpy()))).select(["doc_id", "text"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    texts = map_arrow(source.select("doc_id", "text", slot("doc_id").alias("place")), pick, "doc_id long, text string").join(chosen, "doc_id")
    texts = stored(texts)  # a table: no task runs two Python functions, and a lost executor loses nothing
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    try:
        learn = texts.where(half == 0)
        p, n = ((learn.where(f"toxic = {k}").count()) for k in (1, 0))
        counts = _lexicon_counts(learn).where(F.col("pos") >= LEAST_DOCS)
        odds = F.log((F.col("pos") + 0.5) / (p + 1.0)) - F.log((F.col("neg") + 0.5) / (n + 1.0))
        top = counts.withColumn("w", odds).where(F.col("w") >= LEAST_ODDS).orderBy(F.desc(F.col("w") * F.sqrt("pos")), "form").limit(entries).select("form", "w").toArrow()
        found = dict(zip((x % (1 << 64) for x in top["form"].to_pylist()), top["w"].to_pylist(), strict=True))

        def describe(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            lexical = Lexical(found)
            for lo, hi, words in word_chunks(batch["text"], ALNUM):
                yield pa.RecordBatch.from_arrays([pa.array(list(features(words, lexical)), pa.list_(pa.float64())), batch["toxic"].slice(lo, hi - lo)], ["x", "toxic"])

        rows_ = map_arrow(texts.where(half == 1).select("text", "toxic"), describe, "x array<double>, toxic int").toArrow()
    finally:
        drop_stored(texts)
    x = np.array(rows_["x"].to_pylist(), dtype=float).reshape(-1, KINDS + 2)
    y = rows_["toxic"].to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return Model({}, np.array([0.0] * (KINDS + 2) + [-5.0]))
    times = np.where(y == 1, max(1.0, sizes[1] / sample), max(1.0, sizes[0] / sample))
    return Model(found, _logistic(x, y, times))


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """The toxicity of whole texts.

    ``docs`` has doc_id and text; other columns are ignored. Returns one row per row: doc_id, score (0 to 1), predicted
    (1 from 0.5). Null and empty texts have no clause and get the score of a text without matches. Scan only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    made: list = []  # a task's own scorer

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(Model(**shared.value).scorer())
        score = made[0]
        for lo, hi, words in word_chunks(batch["text"], ALNUM):
            s = score(words)
            yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, score double, predicted int")


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` (text and any other columns, all returned) whose score is below 0.5. Scan only."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    made: list = []  # a task's own scorer

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(Model(**shared.value).scorer())
        score = made[0]
        for lo, hi, words in word_chunks(batch["text"], ALNUM):
            yield batch.slice(lo, hi - lo).filter(pa.array(score(words) < 0.5))

    return map_arrow(docs, run, docs.schema)
