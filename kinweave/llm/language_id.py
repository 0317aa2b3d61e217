"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm._spark import map_arrow
from kinweave.llm._text import U64, binary_parts, chunks, mix
from kinweave.llm._unicode import code_points, letters

#: Hash buckets of n-grams, orders, and additive smoothing of a bucket's count.
BUCKETS, ORDERS, SMOOTHING = 1 << 15, (1, 2, 3), 0.5
UNKNOWN = "und"
#: Characters worked on at once.
PIECE = 1 << 20


def _grams(data: np.ndarray, offsets: np.ndarray, buckets: int, orders: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of letter runs (lower-cased, other characters as one blank), and where each text's begin."""
    chars, first = code_points(data, offsets)
    low = letters()[chars]
    size = len(low)
    blank = low == 32
    edge = np.zeros(size + 1, dtype=bool)
    edge[first] = True
    # A blank goes where the one before it, in the same text, is blank too.
    keep = np.ones(size, dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1]) | edge[1:-1]
    low = low[keep].astype(U64)
    begin = np.concatenate([[0], np.cumsum(keep)])[first]
    doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    out, owner = [], []
    code = np.zeros(len(low), dtype=U64)
    for n in range(1, max(orders) + 1):
        with np.errstate(over="ignore"):
            code = code[: len(low) - n + 1] * U64(0x110000 + 1) + low[n - 1 :] if len(low) >= n else code[:0]
        if n in orders:
            inside = doc[: len(code)] == doc[n - 1 :] if len(code) else np.zeros(0, bool)
            if n == 1:
                inside = inside & (low != 32)
            out.append((mix(code[inside], n) % U64(buckets)).astype(np.int32))
            owner.append(doc[: len(code)][inside])
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(out)[order], np.searchsorted(owners[order], np.arange(len(begin)))


def count_ngrams(docs: DataFrame, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """(lang, bucket, n) over ``docs`` (text, lang); bucket -1 counts documents. Counted whole in each partition before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch["lang"].to_pylist(), dtype=object)
            data, offsets = binary_parts(batch["text"])
            for lo, hi in chunks(offsets, PIECE):
                found, begin = _grams(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], buckets, orders)
                for lang in set(langs[lo:hi].tolist()):
                    rows = np.flatnonzero(langs[lo:hi] == lang)
                    counts = totals.setdefault(lang, np.zeros(buckets + 1, dtype=np.int64))
                    own = np.zeros(hi - lo, dtype=bool)
                    own[rows] = True
                    counts[:-1] += np.bincount(found[np.repeat(own, np.diff(begin))], minlength=buckets)
                    counts[-1] += len(rows)
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            places = np.where(at == buckets, -1, at).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(places), pa.array(counts[at])], ["lang", "bucket", "n"])

    return docs.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class NaiveBayes:
    """Languages, log priors and the log probability of every bucket in every language."""

    def __init__(self, counts: pa.Table, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS, smoothing: float = SMOOTHING):
        langs = counts["lang"].to_pylist()
        self.langs, self.buckets, self.orders = sorted(set(langs)), buckets, orders
        place = {x: i for i, x in enumerate(self.langs)}
        table = np.full((buckets, len(self.langs)), smoothing)
        prior = np.zeros(len(self.langs))
        which, bucket, n = np.array([place[x] for x in langs], dtype=int), counts["bucket"].to_numpy(), counts["n"].to_numpy()
        body = bucket >= 0
        table[bucket[body], which[body]] += n[body]
        prior[which[~body]] = n[~body]
        self.log = np.log(table) - np.log(table.sum(axis=0))
        self.prior = np.log(np.maximum(prior, 1) / max(prior.sum(), 1))

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text and its posterior probability."""
        found, begin = _grams(data, offsets, self.buckets, self.orders)
        some = np.diff(begin) > 0
        sums = np.zeros((len(offsets) - 1, len(self.langs)))
        if self.langs and some.any():
            for k in range(len(self.langs)):
                sums[some, k] = np.add.reduceat(self.log[:, k][found], begin[:-1][some])
            sums += self.prior
            best = sums.argmax(axis=1)
            score = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        else:
            some[:], best, score = False, np.zeros(len(some), int), np.zeros(len(some))
        return [self.langs[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)], np.where(some, score, 0.0)


def fit_language_id(docs: DataFrame, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS) -> NaiveBayes:
    """A model of ``docs`` (text, lang). Rows with null text or lang are left out. The driver gets at most buckets + 1 numbers a language."""
    counts = count_ngrams(docs.select("text", "lang").where("text is not null and lang is not null"), buckets, orders)
    return NaiveBayes(counts.toArrow(), buckets, orders)


def identify_language(docs: DataFrame, model: NaiveBayes) -> DataFrame:
    """The language of whole texts.

    ``docs`` has doc_id and text; other columns are ignored. Returns one row per row: doc_id, lang_pred, score (the
    posterior probability of lang_pred). A null text, or one without a letter, is ``und`` with score 0, as is every
    text if the model learned no language. Scan only; the model is broadcast (buckets x languages numbers).
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = NaiveBayes.__new__(NaiveBayes)
        vars(own).update(shared.value)
        data, offsets = binary_parts(batch["text"])
        for lo, hi in chunks(offsets, PIECE):
            langs, score = own.predict(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), pa.array(langs, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double")
