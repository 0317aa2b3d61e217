"""Benchmark decontamination by winnowing: least k-gram hash of every window, fingerprint join, exact windows behind it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm._spark import FILTER_BITS, filter_of, map_arrow, passes, stored
from kinweave.llm._text import ALNUM, U64, Words, grams, signed, word_chunks

#: Words of a window and of a fingerprinted gram: any shared span of WINDOW words shares a fingerprint.
WINDOW, GRAM = 13, 5
#: A document is contaminated if DEN * hit words >= NUM * words.
NUM, DEN = 1, 20


def _windows(words: Words, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word in the chunk, fingerprint) of every window of ``length`` words that lies in one document."""
    gram = min(gram, length)
    g = grams(words.hash, gram)
    m = len(words.hash) - length + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    least = g[:m].copy()
    for j in range(1, length - gram + 1):
        np.minimum(least, g[j : j + m], out=least)
    end = np.repeat(words.first[1:], np.diff(words.first))[:m]
    at = np.flatnonzero(np.arange(m) + length <= end)
    return np.searchsorted(words.first, at, side="right") - 1, at, least[at]


def _window_hash(words: Words, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows that begin at the words ``at``."""
    if not len(at):
        return np.zeros(0, U64)
    return grams(words.hash[at[:, None] + np.arange(length)].reshape(-1), length, 3)[::length]


def bench_windows(bench: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Distinct (size, fp, wh, item_id): each item's windows with their winnowed fingerprints. An item shorter than a window is one."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, words in word_chunks(batch["text"], ALNUM):
            sizes = np.diff(words.first)
            ids = batch["item_id"].slice(lo, hi - lo)
            for length in np.unique(np.minimum(sizes[sizes > 0], window)):
                doc, at, fp = _windows(words, int(length), gram)
                own = np.minimum(sizes[doc], window) == length
                doc, at, fp = doc[own], at[own], fp[own]
                if len(doc):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), length, np.int32)), pa.array(signed(fp)), pa.array(signed(_window_hash(words, at, int(length)))), ids.take(pa.array(doc))], ["size", "fp", "wh", "item_id"])

    items = bench.select("item_id", "text").where("item_id is not null")
    return map_arrow(items, run, f"size int, fp long, wh long, item_id {items.schema['item_id'].dataType.simpleString()}").distinct()


def _scan(docs: DataFrame, lengths: list[int], gram: int, bitmap: np.ndarray) -> DataFrame:
    """(uid, doc_id, n_words, cands): windows whose fingerprint the benchmark may have. uid names a row's id and text."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, texts = batch["doc_id"].to_pylist(), batch["text"]
        for lo, hi, words in word_chunks(texts, ALNUM):
            parts = []
            for length in lengths:
                doc, at, fp = _windows(words, length, gram)
                ok = passes(bitmap, (fp & U64(FILTER_BITS - 1)).astype(np.int64))
                doc, at, fp = doc[ok], at[ok], fp[ok]
                parts.append((doc, at - words.first[doc], np.full(len(doc), length), signed(fp), signed(_window_hash(words, at, length))))
            doc, start, size, fp, wh = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 5
            order = np.argsort(doc, kind="stable")
            bounds = np.searchsorted(doc[order], np.arange(hi - lo + 1)).astype(np.int32)
            cands = pa.StructArray.from_arrays([pa.array(start[order].astype(np.int32)), pa.array(size[order].astype(np.int32)), pa.array(fp[order]), pa.array(wh[order])], ["start", "size", "fp", "wh"])
            raw, offs = words.data, words.offsets
            uids = [hashlib.blake2b(raw[offs[i] : offs[i + 1]].tobytes(), digest_size=16, key=str(ids[lo + i]).encode()).digest() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.binary()), pa.array(ids[lo:hi], pa.int64()), pa.array(np.diff(words.first), pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), cands)], ["uid", "doc_id", "n_words", "cands"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "uid binary, doc_id long, n_words long, cands array<struct<start:int,size:int,fp:long,wh:long>>")


def _covered(spans: Column) -> Column:
    """Words in the union of sorted spans (start, size)."""
    start = F.struct(F.lit(0).alias("to"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        to = x["start"] + x["size"]
        return F.struct(F.greatest(acc["to"], to).alias("to"), (acc["n"] + F.greatest(F.lit(0), to - F.greatest(acc["to"], x["start"]))).alias("n"))

    return F.aggregate(spans, start, step, lambda acc: acc["n"].cast("long"))


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, gram: int = GRAM, num: int = NUM, den: int = DEN) -> DataFrame:
    """Benchmark passages in documents.

    ``docs`` has doc_id (long) and text, ``bench`` item_id (of any type) and text; other columns are ignored. Returns one row
    per row of ``docs``: doc_id, n_words, n_hit, spans (array of start word and size, where item windows occur),
    item_ids (array, items with occurring windows), contaminated.

    Every window of a document is named by the least hash of its k-grams (winnowing). A filter of fixed size, made of
    the benchmark's fingerprints, drops nearly all at the scan; the rest are joined with the benchmark on fingerprint and
    window hash. No text is shuffled and neither side is broadcast.

    Null or empty texts have no words; items without words or id are left out; with an empty benchmark nothing is hit.
    Rows that repeat each get their result; a null doc_id is kept as it is.
    """
    fingerprints = stored(bench_windows(bench, window, gram))
    lengths = sorted(r[0] for r in fingerprints.select("size").distinct().collect())  # at most `window` numbers
    bitmap = filter_of(fingerprints, F.col("fp").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int"))
    scan = stored(_scan(docs, lengths, gram, bitmap))
    keys = fingerprints.select("size", "fp", "wh").distinct()
    hits = stored(scan.where(F.size("cands") > 0).select("uid", F.inline("cands")).join(keys, ["size", "fp", "wh"], "left_semi").distinct())
    spans = hits.groupBy("uid").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("spans"))
    items = hits.select("uid", "size", "fp", "wh").distinct().join(fingerprints, ["size", "fp", "wh"]).select("uid", "item_id").distinct()
    items = items.groupBy("uid").agg(F.collect_list("item_id").alias("item_ids"))
    none = F.array().cast("array<struct<start:int,size:int>>")
    out = scan.select("uid", "doc_id", "n_words").join(spans, "uid", "left").join(items, "uid", "left")
    out = out.select("doc_id", "n_words", F.coalesce("spans", none).alias("spans"), F.coalesce("item_ids", F.array().cast(items.schema["item_ids"].dataType)).alias("item_ids"))
    out = out.withColumn("n_hit", _covered(F.col("spans")))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * den >= F.col("n_words") * num))
