"""Katz backoff language model: Good-Turing discounts, exactly normalised backoff weights, n-gram tables kept in Spark.

A history's backoff weight is what its seen words leave, over what the next lower order gives to words not seen after it, so
the probabilities of all words and of one unknown word sum to one after every history. A token is evaluated recursively: its
probability at the longest seen order, times the weights of the histories passed on the way down.

Counting and evaluation share one shuffle of packed blocks. A chunk of texts sends each of its distinct n-grams once, with
the documents it stands in, to the bucket of the last word of its history; there all orders above the first meet. A bucket's
n-grams, their counts and places are one row of the stored model. When the counts of all buckets have given the discounts,
each bucket evaluates its own n-grams and returns sums by document. Common words are written as small numbers, rare ones as
64-bit hashes. A word of very many tokens is dealt over several buckets by the word before it, and only its bigram counts
are put together again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm._spark import drop_stored, map_arrow, release, stored, trim
from kinweave.llm._text import SPACED, U64, binary_parts, chunks, mix, signed, word_chunks

#: Longest n-gram; counts above MOST are not discounted.
ORDER, MOST = 3, 5
#: Commonest words, which are broadcast with their counts (8 MB at most) and written as numbers.
HEAD = 1 << 19
#: Bytes of text of a chunk, tokens of a bucket, and tokens of a word that is dealt over several buckets.
CHUNK, BUCKET, HEAVY = 8 << 20, 1 << 20, 1 << 21

_START, _END = (int(mix(np.array([x], U64), 60)[0]) for x in (1, 2))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes: whole numbers in the fewest bytes that hold them, bytes of like weight together."""
    small = []
    for x in arrays:
        if x.dtype.kind in "iu" and len(x) and int(x.min()) >= 0:
            x = x.astype(np.min_scalar_type(int(x.max())))
        small.append(np.ascontiguousarray(x))
    head = json.dumps([[x.dtype.str, len(x)] for x in small]).encode() + b"\0"
    to = zstandard.ZstdCompressor(level=1).compressobj(size=len(head) + sum(x.nbytes for x in small))
    out = [to.compress(head)]
    for x in small:  # one array after the other, so that their bytes are never held together
        out.append(to.compress(x.view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes()))
    return b"".join([*out, to.flush()])


def unpack(raw: bytes) -> list[np.ndarray]:
    """The arrays of :func:`pack`."""
    raw = zstandard.ZstdDecompressor().decompress(raw)
    at = raw.index(b"\0")
    head, out = json.loads(raw[:at]), []
    at += 1
    for kind, n in head:
        dtype = np.dtype(kind)
        size = n * dtype.itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, size, at).reshape(dtype.itemsize, n).T).reshape(-1).view(dtype))
        at += size
    return out


def _fold(columns: list[np.ndarray]) -> np.ndarray:
    """One number a row that orders rows as the columns do."""
    key = columns[0].astype(np.int64)
    for c in columns[1:]:
        if not len(key):
            return key
        width = int(c.max()) + 1
        if int(key.max()) + 1 > (1 << 62) // width:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * width + c
    return key


def _gram_key(columns: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the k-gram and of its history, for rows of n-grams of at least k words."""
    own = columns[len(columns) - k :]
    history = _fold([own[-2], *own[:-2]])
    return _fold([history, own[-1]]), history


class Words1:
    """What every task knows of single words: the head's hashes and training counts, N, V and the unigram discounts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, total: int, types: int, frequency: dict[int, int], most: int):
        order = np.argsort(codes)
        self.sorted, self.rank = codes[order], order.astype(np.int32) + np.int32(1)
        self.codes = np.concatenate([np.array([_START], U64), codes])
        self.counts = np.concatenate([[0], counts]).astype(np.int64)
        self.total, self.types, self.discounts = total, types, discounts(frequency, most)
        kept = total - sum(r * (1 - d) * frequency.get(r, 0) for r, d in enumerate(self.discounts, 1))
        self.base = float(total if kept < total else total + 1)
        self.unknown = 1.0 - kept / self.base if total else 1.0

    @property
    def size(self) -> int:
        """Numbers from here on are of rare words."""
        return len(self.codes)

    def split(self) -> np.ndarray:
        """Buckets that a word's n-grams are dealt over, by number."""
        return np.where(self.counts > HEAVY, -(-self.counts // BUCKET), 1)

    def numbers(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word, and the sorted hashes of the rare ones; START is 0."""
        one, which = np.unique(words, return_inverse=True)
        place = np.minimum(np.searchsorted(self.sorted, one), max(len(self.sorted) - 1, 0))
        known = self.sorted[place] == one if len(self.sorted) else np.zeros(len(one), bool)
        out = np.empty(len(one), dtype=np.int32)
        out[known] = self.rank[place[known]]
        out[~known] = self.size + np.arange((~known).sum())
        return out[which], one[~known]

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, _discounted(counts, self.discounts) / self.base, self.unknown)

    def add_one(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / float(self.total + self.types + 1))


def discounts(counts: dict[int, int], most: int = MOST) -> list[float]:
    """Good-Turing discount of counts 1..most from the numbers of n-grams seen r times (Katz, 1987).

    Where the numbers are too few for a discount between 0 and 1, it is (r - d) / r with d = n1 / (n1 + 2 n2).
    """
    n = [counts.get(r, 0) for r in range(most + 2)]
    plain = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    plain = min(max(plain, 0.1), 0.9)
    tail = (most + 1) * n[most + 1] / n[1] if n[1] else 1.0
    out = []
    for r in range(1, most + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if n[r] and tail < 1 else 0.0
        out.append(d if 0 < d < 1 else (r - plain) / r)
    return out


def _discounted(counts: np.ndarray, by: list[float]) -> np.ndarray:
    factor = np.array([0.0, *by])
    return counts * np.where(counts <= len(by), factor[np.minimum(counts, len(by))], 1.0)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, word hashes, words by document) of chunks of a batch."""
    column = batch["text"]
    _, offsets = binary_parts(column)
    for lo, hi in chunks(offsets, CHUNK):
        hashes, sizes = [], []
        for _, _, words in word_chunks(column.slice(lo, hi - lo), SPACED):
            hashes.append(words.hash)
            sizes.append(np.diff(words.first))
        yield lo, hi, np.concatenate(hashes), np.concatenate(sizes)


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c): training counts of words and of the end, counted in each chunk before the shuffle."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        train = batch["train"].to_numpy(zero_copy_only=False)
        for lo, hi, words, sizes in _pieces(batch):
            own = train[lo:hi]
            one, n = np.unique(np.append(words[np.repeat(own, sizes)], np.full(own.sum(), _END, U64)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(one)), pa.array(n.astype(np.int64))], ["word", "c"])

    return map_arrow(rows.select("text", "train"), run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Grams:
    """The distinct n-grams of a chunk in order, the tokens of each, and the document of each token."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, order: int, known: Words1, buckets: int):
        doc = np.repeat(np.arange(len(sizes)), sizes + 1)
        last = np.cumsum(sizes + 1) - 1
        every = np.full(len(doc), _END, dtype=U64)
        inner = np.ones(len(doc), dtype=bool)
        inner[last] = False
        every[inner] = words
        number, self.rare = known.numbers(every)
        place = np.arange(len(doc)) - np.repeat(last - sizes, sizes + 1)
        columns = [number]
        for back in range(1, order):
            before = np.zeros_like(number)
            if back < len(number):
                before[back:] = number[:-back]
            before[place < back] = 0
            columns.append(before)
        del every, inner, place
        columns = columns[::-1]  # w1 ... wm
        key = _fold([columns[-2], *columns[:-2], columns[-1]])
        by = np.argsort(key, kind="stable")
        key = key[by]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        self.columns = [c[by][first] for c in columns]
        self.times = np.diff(np.append(first, len(key)))
        self.doc = doc[by]
        self.bucket = _bucket(self.columns, self.rare, known, buckets)

    def by_bucket(self, known: Words1) -> Iterator[tuple[int, bytes, list[np.ndarray]]]:
        """(bucket, rare words, n-grams, tokens of each, documents) by bucket."""
        by = np.argsort(self.bucket, kind="stable")
        begin = np.cumsum(self.times) - self.times
        edges = np.flatnonzero(np.append(True, np.diff(self.bucket[by]) != 0)) if len(by) else by
        for lo, hi in zip(edges, np.append(edges[1:], len(by)), strict=True):
            own = by[lo:hi]
            columns = [c[own] for c in self.columns]
            rare = np.unique(np.concatenate([c[c >= known.size] for c in columns]))
            columns = [np.where(c >= known.size, known.size + np.searchsorted(rare, c), c) for c in columns]
            times = self.times[own]
            at = np.arange(times.sum()) + np.repeat(begin[own] - np.cumsum(times) + times, times)
            yield int(self.bucket[own[0]]), self.rare[rare - known.size], [*columns, times, self.doc[at]]


def _bucket(columns: list[np.ndarray], rare: np.ndarray, known: Words1, buckets: int) -> np.ndarray:
    """Where n-grams go: by the last word of the history, and where that is heavy, by the word before it too."""
    codes = np.concatenate([known.codes, rare])
    part = np.zeros(len(columns[0]), dtype=U64)
    if len(columns) > 2:
        ways = np.append(known.split(), np.ones(len(rare), dtype=np.int64))[columns[-2]]
        many = ways > 1
        part[many] = mix(codes[columns[-3][many]], 62) % ways[many].astype(U64)
    return (mix(mix(codes[columns[-2]], 63) ^ part, 64) % U64(buckets)).astype(np.int32)


def _sub_buckets(known: Words1, buckets: int) -> dict[int, list[int]]:
    """The buckets of each heavy word, by number."""
    ways = known.split()
    return {int(b): sorted({int(mix(mix(known.codes[b : b + 1], 63) ^ U64(s), 64)[0] % U64(buckets)) for s in range(ways[b])}) for b in np.flatnonzero(ways > 1)}


_ROW = "bucket int, chunk binary, blob binary, words array<long>, counts array<long>"


def _sent(rows: DataFrame, order: int, known, buckets: int) -> DataFrame:
    """Packed n-grams of chunks by bucket; a chunk's list of documents goes to a bucket below zero."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        train = batch["train"].to_numpy(zero_copy_only=False)
        for lo, hi, words, sizes in _pieces(batch):
            ids = batch["doc_id"].slice(lo, hi - lo)
            none, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            name = hashlib.blake2b(words.tobytes() + sizes.tobytes() + ids.tobytes() + none.tobytes(), digest_size=16).digest()
            flags = np.packbits(train[lo:hi])
            out = [(-1 - int.from_bytes(name[:4]) % buckets, pack(ids, none, train[lo:hi], sizes + 1))]
            for bucket, rare, arrays in Grams(words, sizes, order, known.value, buckets).by_bucket(known.value):
                arrays[-4] = np.diff(arrays[-4], prepend=0)  # the last word of the history: ascending
                out.append((bucket, pack(rare, *arrays, flags, np.array([hi - lo]))))
            n = len(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in out], pa.int32()), pa.array([name] * n, pa.binary()), pa.array([x for _, x in out], pa.binary()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))],
                ["bucket", "chunk", "blob", "words", "counts"],
            )

    return map_arrow(rows, run, _ROW)


def _rare_words(rows: DataFrame, order: int, known, buckets: int) -> DataFrame:
    """(bucket, word): the rare words that n-grams of a bucket end with, each once a chunk."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for _, _, words, sizes in _pieces(batch):
            own = Grams(words, sizes, order, known.value, buckets)
            at = own.columns[-1] >= known.value.size
            pairs = np.unique(own.bucket[at].astype(np.int64) * (len(own.rare) + 1) + own.columns[-1][at] - known.value.size)
            bucket, word = np.divmod(pairs, len(own.rare) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(signed(own.rare[word]))], ["bucket", "word"])

    return map_arrow(rows.select("text"), run, "bucket int, word long")


def _grouped(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[tuple[object, list[dict]]]:
    """Runs of rows with equal ``by``, from sorted batches."""
    now, held = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch[c][i].as_py() for c in batch.schema.names}
            if held and row[by] != now:
                yield now, held
                held = []
            now = row[by]
            held.append(row)
    if held:
        yield now, held


_MODEL = "bucket int, chunk binary, blob binary, seen array<long>, heavy array<long>, last array<long>, times array<long>, ones array<long>"


def _merged(sent: DataFrame, order: int, most: int, known, heavy: list[int]) -> DataFrame:
    """The stored model: a bucket's distinct n-grams with training counts and places, and numbers of n-grams seen r times.

    For heavy words, the bigrams' counts (heavy, last word, count, count of the last word) leave as well.
    """
    split = np.array(heavy, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _grouped(batches, "bucket"):
            if bucket < 0:
                out = [{"bucket": bucket, "chunk": r["chunk"], "blob": r["blob"]} for r in rows]
            else:
                out = [_merge(bucket, rows, order, most, known.value, split)]
            for r in out:
                yield pa.RecordBatch.from_pylist([r], schema=kind)
            del out, r, rows
            trim()

    long = pa.list_(pa.int64())
    kind = pa.schema([("bucket", pa.int32()), ("chunk", pa.binary()), ("blob", pa.binary()), *((c, long) for c in ("seen", "heavy", "last", "times", "ones"))])
    return sent.mapInArrow(run, _MODEL)


def _merge(bucket: int, rows: list[dict], order: int, most: int, known: Words1, split: np.ndarray) -> dict:
    parts, names, rare = [], [], [np.zeros(0, U64)]
    told = {"words": np.zeros(0, U64), "counts": np.zeros(0, np.int64)}
    for r in rows:
        if r["blob"] is None:
            told = {"words": np.array(r["words"], dtype=np.int64).view(U64), "counts": np.array(r["counts"], dtype=np.int64)}
        else:
            arrays = unpack(r["blob"])
            rare.append(arrays[0].astype(U64))
            parts.append(arrays[1:])
            names.append(r["chunk"])
    rows.clear()
    every = np.unique(np.concatenate(rare))
    columns, counts, ends = [[] for _ in range(order)], [], [0]
    for own, arrays in zip(rare[1:], parts, strict=True):
        arrays[order - 2] = np.cumsum(arrays[order - 2].astype(np.int64))
        to = known.size + np.searchsorted(every, own)
        for c, x in zip(columns, arrays[:order], strict=True):
            x = x.astype(np.int64)
            high = x >= known.size
            x[high] = to[x[high] - known.size]
            c.append(x.astype(np.int32))
        times, doc, flags, n = arrays[order:]
        train = np.unpackbits(flags, count=int(n[0]))[doc].astype(np.int64)
        counts.append(np.add.reduceat(train, np.cumsum(times.astype(np.int64)) - times) if len(times) else times.astype(np.int64))
        ends.append(ends[-1] + len(times))
        arrays[:order] = [None] * order  # what a bucket no longer needs goes at once: a task's memory is bounded
        del train
    for i in range(order):
        columns[i] = np.concatenate(columns[i])
    key = _fold([columns[-2], *columns[:-2], columns[-1]])
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    del key
    which = which.astype(np.int32)
    for i in range(order):
        columns[i] = columns[i][first]
    count = np.bincount(which, weights=np.concatenate(counts), minlength=len(first)).astype(np.int64)
    del counts, first
    places = []
    for i, (name, arrays) in enumerate(zip(names, parts, strict=True)):
        times, doc, _, n = arrays[order:]
        places += [np.frombuffer(name, np.uint8), n, np.diff(which[ends[i] : ends[i + 1]], prepend=np.int32(0)), times, doc]
    del which, parts
    ones = np.zeros(len(every), dtype=np.int64)  # training counts of the rare words
    if len(told["words"]):
        at = np.searchsorted(every, told["words"])
        ones[at] = told["counts"]
    seen = np.zeros((order - 1, most + 1), dtype=np.int64)
    dealt = np.isin(columns[-2], split)
    out: dict = {"heavy": [], "last": [], "times": [], "ones": []}
    for k in range(2, order + 1):
        own = ~dealt if k == 2 else np.ones(len(count), bool)
        total = count[own]
        if k < order and len(total):  # those of the whole order are distinct as they are
            gram, _ = _gram_key([c[own] for c in columns[-k:]], k)
            by = np.argsort(gram, kind="stable")
            gram = gram[by]
            total = np.add.reduceat(total[by], np.flatnonzero(np.append(True, gram[1:] != gram[:-1])))
            del gram, by
        seen[k - 2] = [(total == r).sum() for r in range(1, most + 2)]
    if dealt.any():
        gram, _ = _gram_key([c[dealt] for c in columns], 2)
        _, at, to = np.unique(gram, return_index=True, return_inverse=True)
        total = np.bincount(to, weights=count[dealt]).astype(np.int64)
        some = total > 0
        last = columns[-1][dealt][at][some]
        one = np.append(known.counts, ones)[last]
        out = {"heavy": columns[-2][dealt][at][some].tolist(), "last": signed(np.append(known.codes, every)[last]).tolist(), "times": total[some].tolist(), "ones": one.tolist()}
    columns[-2] = np.diff(columns[-2], prepend=0)
    blob = pack(every, ones, *columns, count, *places)
    return {"bucket": bucket, "chunk": None, "blob": blob, "seen": seen.reshape(-1).tolist(), **out}


def evaluate(columns: list[np.ndarray], count: np.ndarray, one: np.ndarray, by: dict[int, list[float]], unigram: np.ndarray, dealt: dict[int, tuple] | None = None) -> np.ndarray:
    """log10 p of each n-gram's last word after its history, for all n-grams of some histories.

    ``columns`` are word numbers, ``count`` training counts (0: not seen in training), ``one`` numbers of last words in
    ``dealt``, ``unigram`` probabilities of last words. ``dealt`` has, for a heavy word: the numbers and counts of the
    words seen after it and their unigram probabilities.
    """
    q = unigram
    for k in range(2, len(columns) + 1):
        gram, history = _gram_key(columns, k)
        _, first, which = np.unique(gram, return_index=True, return_inverse=True)
        _, owner = np.unique(history, return_inverse=True)
        c = np.bincount(which, weights=count).astype(np.int64)
        of = owner[first]  # the history of each distinct gram
        s = _discounted(c, by[k])
        total, kept = np.bincount(of, weights=c), np.bincount(of, weights=s)
        lower = np.bincount(of, weights=np.where(c > 0, q[first], 0.0))
        if k == 2 and dealt:
            for b, (words, times, p) in dealt.items():
                at = np.flatnonzero(columns[-2][first] == b)
                if len(at):
                    place = np.minimum(np.searchsorted(words, one[first[at]]), len(words) - 1)
                    c[at] = np.where(words[place] == one[first[at]], times[place], 0)
                    s[at] = _discounted(c[at], by[2])
                    h = of[at[0]]
                    total[h], kept[h], lower[h] = times.sum(), _discounted(times, by[2]).sum(), p.sum()
        base = np.where(kept < total, total, total + 1)  # a history that discounts nothing leaves one count
        alpha = np.where(total > 0, np.maximum(1 - kept / base, 1e-12) / np.maximum(1 - lower, 1e-12), 1.0)
        p = np.where(c > 0, s / base[of], alpha[of] * q[first])
        q = p[which]
        del gram, history, first, which, owner, c, of, s, total, kept, lower, base, alpha, p  # else they stay through the next order
    return np.log10(q)


def _sums(model: DataFrame, order: int, known, by: dict[int, list[float]]) -> DataFrame:
    """(chunk, blob): sums of score, base score and known tokens by document of a chunk, over the buckets of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        size = 0
        for _, rows in _grouped(batches, "bucket"):
            own, pieces = None, []
            for r in rows:
                if r["seen"] is None:
                    pieces.append(unpack(r["blob"]))
                else:
                    own = unpack(r["blob"])
            rows.clear()
            if own is None:
                continue
            rare, ones, *rest = own
            columns, count, places = [x.astype(np.int32) for x in rest[:order]], rest[order].astype(np.int64), rest[order + 1 :]
            columns[-2] = np.cumsum(columns[-2], dtype=np.int32)
            rest = own = None
            c1 = np.append(known.value.counts, ones)[columns[-1]].astype(np.int64)
            code = np.append(known.value.codes, rare.astype(U64))[columns[-1]] if pieces else np.zeros(0, U64)
            dealt = {}
            if pieces:
                b, word, times, one = (np.concatenate(x) for x in zip(*pieces, strict=True))
                for x in np.unique(b):
                    at = b == x
                    order_ = np.argsort(word[at])
                    dealt[int(x)] = (word[at].astype(U64)[order_], times[at][order_].astype(np.int64), known.value.probability(one[at][order_].astype(np.int64)))
            score = evaluate(columns, count, code, by, known.value.probability(c1), dealt)
            add, seen = known.value.add_one(c1), (c1 > 0).astype(np.float64)
            for name, n, idx, times, doc in zip(*(places[i::5] for i in range(5)), strict=True):
                at = np.repeat(np.cumsum(idx.astype(np.int64)), times.astype(np.int64))
                now = np.stack([np.bincount(doc, weights=x[at], minlength=int(n[0])) for x in (score, add, seen)])
                key = name.astype(np.uint8).tobytes()
                if key in held:
                    held[key] += now
                else:
                    held[key] = now
                    size += now.nbytes
            if size > 48 << 20:
                yield from out(held)
                held, size = {}, 0
            del own, rest, columns, places, score, add, seen, c1, code
            trim()
        yield from out(held)

    def out(held: dict[bytes, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, x in held.items():
            used = np.flatnonzero(x[1])
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([pack(used, *x[:, used])], pa.binary()), pa.array([False])], ["chunk", "blob", "whole"])

    return model.mapInArrow(run, "chunk binary, blob binary, whole boolean")


def _scores(sums: DataFrame, total: int) -> DataFrame:
    """Rows of documents, from the sums of their chunks (sorted by chunk) and their lists (whole)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, "chunk"):
            lists = [unpack(r["blob"]) for r in rows if r["whole"]]
            parts = [unpack(r["blob"]) for r in rows if not r["whole"]]
            ids, none, train, sizes = lists[0]
            x = np.zeros((3, len(ids)))
            for used, *values in parts:
                x[:, used.astype(np.int64)] += np.stack(values)
            made = [pa.array(ids.astype(np.int64), pa.int64(), mask=none.astype(bool)), pa.array(train.astype(bool)), pa.array(sizes.astype(np.int64)), pa.array(np.rint(x[2]).astype(np.int64)), pa.array(np.full(len(ids), total)), pa.array(x[1]), pa.array(x[0])]
            for _ in lists:  # equal chunks share their sums
                share = [*made[:3], pa.array(np.rint(x[2] / len(lists)).astype(np.int64)), made[4], pa.array(x[1] / len(lists)), pa.array(x[0] / len(lists))]
                yield pa.RecordBatch.from_arrays(share, ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return sums.mapInArrow(run, "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def katz_scores(docs: DataFrame, train: Column, order: int = ORDER, most: int = MOST) -> DataFrame:
    """Log10 probabilities of whole texts under a Katz model learned from the rows that meet ``train``.

    ``docs`` has doc_id and text; other columns are ignored, whatever their names. Words are SPACED words, lower-cased,
    and each text has one end after them. ``order`` is at least 2. Returns one row per row: doc_id, train, n_tokens,
    n_known, train_tokens, base_score (add-one unigrams) and score. Null texts are empty: one token, the end. With nothing
    to learn from, every word is unknown and its probability one. Repeated rows each count in training and each get their
    score. An empty table gives an empty result.

    ``docs`` is read three times and must give the same rows each time, in whatever order: words are counted, rare words
    looked up, n-grams sent. What is gathered grows with the input: no count is left out.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.coalesce("text", F.lit("")).alias("text"))
    singles = stored(word_counts(rows))
    freq = {r[0]: r[1] for r in singles.where(F.col("c") <= most + 1).groupBy("c").count().collect()}
    sums = singles.agg(F.sum("c"), F.count("*")).first()
    total, types = int(sums[0] or 0), int(sums[1])
    top = singles.orderBy(F.desc("c"), "word").limit(HEAD).toArrow()
    known = Words1(top["word"].to_numpy().astype(np.int64).view(U64), top["c"].to_numpy(), total, types, freq, most)
    heavy = _sub_buckets(known, 1) if order > 2 else {}
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total * 5 // (4 * BUCKET)))
    shared = spark.sparkContext.broadcast(known)
    release(spark)

    rare = _rare_words(rows, order, shared, buckets).distinct().join(singles, "word")
    rare = stored(rare.select("bucket", "word", "c"))
    drop_stored(singles)
    release(spark)
    told = rare
    rare = rare.groupBy("bucket").agg(F.collect_list(F.struct("word", "c")).alias("x")).select("bucket", F.lit(None).cast("binary").alias("chunk"), F.lit(None).cast("binary").alias("blob"), F.col("x.word").alias("words"), F.col("x.c").alias("counts"))
    sent = _sent(rows, order, shared, buckets).unionByName(rare).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    model = stored(_merged(sent, order, most, shared, sorted(heavy)))
    drop_stored(told)
    release(spark)

    grams = model.where("bucket >= 0")
    numbers = grams.select(F.posexplode("seen")).groupBy("pos").agg(F.sum("col").alias("n")).collect()
    seen = np.zeros((order - 1) * (most + 1), dtype=np.int64)
    for r in numbers:
        seen[r["pos"]] = r["n"]
    seen = seen.reshape(order - 1, most + 1)
    again = None
    if heavy:
        bigrams = grams.select(F.explode(F.arrays_zip("heavy", "last", "times", "ones")).alias("x")).select("x.*").groupBy("heavy", "last").agg(F.sum("times").alias("times"), F.max("ones").alias("ones"))
        again = stored(bigrams)
        for r in again.where(F.col("times") <= most + 1).groupBy("times").count().collect():
            seen[0, r["times"] - 1] += r["count"]
    by = {k: discounts({r: int(n) for r, n in enumerate(seen[k - 2], 1)}, most) for k in range(2, order + 1)}
    none = F.lit(None).cast("array<long>")
    if again is not None:
        to = _sub_buckets(known, buckets)
        pieces = _heavy_pieces(again, to).select("bucket", "blob", none.alias("seen"))
        places = sorted({x for own in to.values() for x in own})
        apart = grams.where(F.col("bucket").isin(places)).select("bucket", "blob", "seen").unionByName(pieces)
        parts = _sums(apart.repartition("bucket").sortWithinPartitions("bucket"), order, shared, by)
        parts = parts.unionByName(_sums(grams.where(~F.col("bucket").isin(places)).select("bucket", "blob", "seen"), order, shared, by))
    else:
        parts = _sums(grams.select("bucket", "blob", "seen"), order, shared, by)
    lists = model.where("bucket < 0").select("chunk", "blob", F.lit(True).alias("whole"))
    return _scores(parts.unionByName(lists).repartition("chunk").sortWithinPartitions("chunk"), total)


def _heavy_pieces(bigrams: DataFrame, to: dict[int, list[int]]) -> DataFrame:
    """(bucket, blob): the bigrams (heavy, last, times, ones) of heavy words, packed, for each bucket that has some of the word."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        word, last, times, ones = (batch[c].to_numpy().astype(np.int64) for c in ("heavy", "last", "times", "ones"))
        buckets, blobs = [], []
        for b in np.unique(word):
            at = np.flatnonzero(word == b)
            at = at[np.argsort(last[at].view(U64))]
            blob = pack(word[at], last[at].view(U64), times[at], ones[at])
            buckets += to[int(b)]
            blobs += [blob] * len(to[int(b)])
        yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

    return map_arrow(bigrams, run, "bucket int, blob binary")
