"""Removal of long repeated byte strings with a logarithmic family of sparse suffix indexes.

Every string of LENGTH bytes names one of its suffixes by its content alone: the one at the least gram hash of its first
WINDOW grams. Only these suffixes are indexed, about one in WINDOW / 2 bytes, ordered by the name (hash) of their first
CORE bytes, which any two equal strings of LENGTH bytes share. New batches get such a sorted suffix table, are merge-scanned
against the existing levels, and levels of equal rank merge into the next. Suffixes whose name repeats are then refined to
exact positions: whole contexts first, blocks of starts next, single starts last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm._spark import FILTER_BITS, drop_stored, filter_of, map_arrow, passes, quoted, release, repeated, stored
from kinweave.llm._text import SPACED, U64, Words, WordSums, binary_parts, chunks, grams, mix, prefix_sums, signed, span_hash, word_chunks

#: Bytes of a string that counts as repeated.
LENGTH = 400
#: Starts that one suffix can stand for, bytes of a gram, starts of a block in the refinement, batches of the index.
WINDOW, GRAM, BLOCK, BATCHES = 256, 16, 16, 4
#: Bytes of text scanned at once: arrays of eight bytes for each are near what a core's cache holds.
PIECE = 1 << 16
#: Words of a passage that counts as repeated, starts that one of its suffixes can stand for, words of a gram.
PASSAGE, PASSAGE_WINDOW, PASSAGE_GRAM = 51, 24, 4


def _sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by minima of 2, 4, 8, ... of them."""
    done = 1
    while done < w:
        step = min(done, w - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of each GRAM bytes, read as two 64-bit numbers."""
    n = len(data) - 7
    if n <= 8:
        return np.zeros(0, dtype=U64)
    eight = np.ndarray(n, "<u8", np.ascontiguousarray(data).data, strides=(1,)).astype(U64)
    with np.errstate(over="ignore"):
        return mix(eight[:-8] * U64(0x9E3779B97F4A7C15) + eight[8:], 42)


def sampled(h: np.ndarray, n: int, offsets: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix, first start, last start) of the runs of starts that name the same suffix.

    ``h`` has the gram hash of each of the ``n`` units (bytes or words) but the last few; starts have ``length`` units in
    their text.
    """
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none
    at = np.arange(len(h))
    least = _sliding_least((h & U64(0xFFFFFFFF00000000)) | at.astype(U64), window)
    owner = (least & U64(0xFFFFFFFF)).astype(np.int64)[: n - length + 1]
    end = np.repeat(offsets[1:], np.diff(offsets))[: len(owner)]
    start = np.flatnonzero(np.arange(len(owner)) + length <= end)
    if not len(start):
        return none, none, none
    own = owner[start]
    edge = np.flatnonzero((np.diff(own) != 0) | (np.diff(start) != 1)) + 1
    lo, hi = np.concatenate([[0], edge]), np.concatenate([edge, [len(start)]]) - 1
    return own[lo], start[lo], start[hi]


class SuffixIndex:
    """A family of levels; level r holds the names of about 2**r batches' suffixes, sorted, each name once."""

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}

    def insert(self, names: DataFrame) -> DataFrame:
        """Adds a batch's suffix names (column name) and returns those that occur twice in it or in it and a level before."""
        own = stored(names.groupBy("name").agg(F.count("*").alias("n")).sortWithinPartitions("name"))
        found = own.where("n > 1").select("name")
        for level in self.levels.values():
            found = found.unionByName(own.select("name").join(level, "name", "left_semi"))
        found = stored(found.distinct())
        rank, merged = 0, own.select("name")
        while rank in self.levels:
            merged = stored(merged.unionByName(self.levels.pop(rank)).distinct().sortWithinPartitions("name"))
            rank += 1
        self.levels[rank] = merged
        return found


def _more_than_once(names: DataFrame) -> DataFrame:
    return names.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")


def _keyed(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(k1, k2, doc_id, text, rest): two hashes of id and text name a row; rest is a struct of the carried columns."""
    doc_id = F.col("doc_id").cast("long")
    rest = F.struct(*map(quoted, carry)) if carry else F.struct(F.lit(0).alias("none"))
    return docs.select(rest.alias("rest"), F.xxhash64(doc_id, "text").alias("k1"), F.xxhash64("text", doc_id, F.lit("second")).alias("k2"), doc_id.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _scan(keyed: DataFrame, length: int, window: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = binary_parts(batch["text"])
        for lo, hi in chunks(offsets, PIECE):
            offs, piece = offsets[lo : hi + 1] - offsets[lo], data[offsets[lo] : offsets[hi]]
            if len(piece) < length:
                continue
            sums = prefix_sums(piece)
            p, a, b = sampled(gram_hashes(piece), len(piece), offs, length, window)
            doc = np.searchsorted(offs, p, side="right") - 1
            row, base = pa.array(doc + lo), offs[doc]
            yield pa.RecordBatch.from_arrays(
                [batch["k1"].take(row), batch["k2"].take(row), *(pa.array((x - base).astype(np.int32)) for x in (p, a, b)), pa.array(signed(span_hash(sums, p, p + length - window + 1, 43))), pa.array(signed(span_hash(sums, a, b + length, 44)))],
                ["k1", "k2", "p", "lo", "hi", "core", "whole"],
            )

    return map_arrow(keyed.select("k1", "k2", "text"), run, "k1 long, k2 long, p int, lo int, hi int, core long, whole long")


def _at_texts(keyed: DataFrame, places: DataFrame, columns: list[str], function, schema: str) -> DataFrame:
    """``function(bytes, *places)`` for the documents that ``places`` (k1, k2, ``columns``) names.

    A document's places travel as one row, their number bounded by its length; a filter of fixed size keeps most other
    documents' texts out of the shuffle.
    """
    lists = places.groupBy("k1", "k2").agg(F.collect_list(F.struct(*columns)).alias("places"))
    bitmap = filter_of(places.select("k1").distinct(), F.col("k1").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int"))
    texts = _texts(keyed, bitmap, True).select("k1", "k2", "text")
    names = ["k1", "k2", *(x.split()[0] for x in schema.split(", "))]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = binary_parts(batch["text"])
        begin = batch["places"].offsets.to_numpy().astype(np.int64)
        fields = [f.to_numpy(zero_copy_only=False).astype(np.int64) for f in batch["places"].values.flatten()]
        for i in range(batch.num_rows):
            out = function(data[offsets[i] : offsets[i + 1]], *(f[begin[i] : begin[i + 1]] for f in fields))
            n = len(out[0])
            if n:
                keys = [pa.array(np.full(n, batch[k][i].as_py(), dtype=np.int64)) for k in ("k1", "k2")]
                yield [*keys, *out]

    def batched(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        held: list[list[pa.Array]] = []
        size = 0
        for arrays in run(batch):
            held.append(arrays)
            size += len(arrays[0])
            if size >= 100_000:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*held, strict=True)], names)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*held, strict=True)], names)

    # Shuffled even where small: else a task would run two Python functions, in a process each.
    return map_arrow(texts.join(lists.hint("merge"), ["k1", "k2"]), batched, f"k1 long, k2 long, {schema}")


def _texts(keyed: DataFrame, bitmap: np.ndarray, inside: bool) -> DataFrame:
    """The rows of ``keyed`` that a filter of their keys lets through, or does not."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ok = passes(bitmap, batch["k1"].to_numpy() & (FILTER_BITS - 1))
        yield batch.filter(pa.array(ok if inside else ~ok))

    return map_arrow(keyed, run, keyed.schema)


def _with_partners(rows: DataFrame, shared: str, name: str, columns: list[str]) -> DataFrame:
    """The rows not yet known to repeat in full, and one row of each repeated ``name`` that has ``shared`` in common with them."""
    left = rows.where("not full")
    least = rows.where("full").groupBy(name).agg(F.min(F.struct(shared, *columns)).alias("r")).select("r.*")
    partners = least.join(left.select(shared).distinct(), shared, "left_semi")
    return left.select(columns).unionByName(partners.select(columns))


def _every(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers of all the ranges [lo, hi]."""
    count = hi - lo + 1
    return np.arange(count.sum()) + np.repeat(lo - np.cumsum(count) + count, count)


def repeated_spans(keyed: DataFrame, length: int = LENGTH, window: int = WINDOW, batches: int = BATCHES) -> DataFrame:
    """(k1, k2, lo, to): byte spans covered by strings of ``length`` bytes that start in more than one place."""
    suffixes = stored(_scan(keyed, length, window))
    index, found = SuffixIndex(), []
    for b in range(batches):
        found.append(index.insert(suffixes.where(F.pmod("k1", F.lit(batches)) == b).select(F.col("core").alias("name"))))
    names = found[0]
    for x in found[1:]:
        names = names.unionByName(x)
    names = stored(names.distinct())
    bitmap = filter_of(names, F.col("name").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int"))
    # 1. Suffixes whose whole context, all their starts, repeats.
    some = stored(_named(suffixes, bitmap))
    drop_stored(suffixes)
    cores = stored(repeated(some, "core", "again").where("again").drop("again"))
    known = stored(repeated(cores, "whole", "full"))
    for x in (some, cores, names, *found, *index.levels.values()):
        drop_stored(x)
    release(keyed.sparkSession)
    spans = known.where("full").select("k1", "k2", "lo", (F.col("hi") + length).alias("to"))

    # 2. Blocks of the others' starts: what a block's strings share must repeat; if all its bytes do, so do all its strings.
    def blocks(text: np.ndarray, p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[pa.Array]:
        sums = prefix_sums(text)
        first, last = (p - hi) // BLOCK, (p - lo) // BLOCK
        which, j = np.repeat(np.arange(len(p)), last - first + 1), _every(first, last)
        a, b = np.maximum(p[which] - BLOCK * j - BLOCK + 1, lo[which]), np.minimum(p[which] - BLOCK * j, hi[which])
        inner = span_hash(sums, p[which] - BLOCK * j, p[which] - BLOCK * j - BLOCK + 1 + length, 45)
        outer = span_hash(sums, a, b + length, 46)
        return [pa.array(x.astype(np.int32)) for x in (a, b)] + [pa.array(signed(x)) for x in (inner, outer)]

    open_ = _with_partners(known, "core", "whole", ["k1", "k2", "p", "lo", "hi"])
    parts = stored(_at_texts(keyed, open_, ["p", "lo", "hi"], blocks, "lo int, hi int, inner long, outer long"))
    inside = stored(repeated(parts, "inner", "again").where("again").drop("again"))
    drop_stored(parts)
    parts = stored(repeated(inside, "outer", "full"))
    drop_stored(inside)
    release(keyed.sparkSession)
    spans = spans.unionByName(parts.where("full").select("k1", "k2", "lo", (F.col("hi") + length).alias("to")))

    # 3. Single starts of the blocks that repeat in part.
    def starts(text: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[pa.Array]:
        at = _every(lo, hi)
        return [pa.array(at.astype(np.int32)), pa.array(signed(span_hash(prefix_sums(text), at, at + length, 47)))]

    open_ = _with_partners(parts, "inner", "outer", ["k1", "k2", "lo", "hi"])
    single = stored(_at_texts(keyed, open_, ["lo", "hi"], starts, "lo int, name long"))
    single = repeated(single, "name", "again").where("again")
    return spans.unionByName(single.select("k1", "k2", "lo", (F.col("lo") + length).alias("to")))


def _named(suffixes: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """The suffixes whose core a filter of names lets through."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(passes(bitmap, batch["core"].to_numpy() & (FILTER_BITS - 1))))

    return map_arrow(suffixes, run, suffixes.schema)


def repeated_passages(keyed: DataFrame, words: int = PASSAGE, window: int = PASSAGE_WINDOW) -> DataFrame:
    """(k1, k2, lo, to): byte spans covered by runs of ``words`` words that start in more than one place, letter case aside.

    The same sampling over words: each run names one suffix, whose name must repeat; then whole contexts, then single runs.
    """

    def described(batch: pa.RecordBatch) -> Iterator[tuple]:
        for lo, _, found in word_chunks(batch["text"], SPACED, PIECE):
            g = grams(found.hash, PASSAGE_GRAM)
            p, a, b = sampled(g, len(found.hash), found.first, words, window)
            core = grams(found.hash, words - window + 1)[p] if len(p) else g[:0]
            yield lo, found, p, a, b, core

    def names(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for *_, core in described(batch):
            one, n = np.unique(core, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(one)), pa.array(n)], ["name", "n"])

    counts = map_arrow(keyed.select("text"), names, "name long, n long").groupBy("name").agg(F.sum("n").alias("n"))
    bitmap = filter_of(counts.where("n > 1"), F.col("name").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int"))

    def places(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, found, p, a, b, core in described(batch):
            ok = passes(bitmap, (core & U64(FILTER_BITS - 1)).astype(np.int64))
            p, a, b, core = p[ok], a[ok], b[ok], core[ok]
            doc = np.searchsorted(found.first, p, side="right") - 1
            row, base = pa.array(doc + lo), found.first[doc]
            bytes_ = [x - found.offsets[doc] for x in (found.start[a], found.end[np.minimum(b + words, len(found.end)) - 1])]
            whole = span_hash(WordSums(found.hash), a, b + words, 48)
            yield pa.RecordBatch.from_arrays(
                [batch["k1"].take(row), batch["k2"].take(row), *(pa.array(x.astype(np.int32)) for x in (a - base, b - base, *bytes_)), pa.array(signed(core)), pa.array(signed(whole))],
                ["k1", "k2", "lo", "hi", "from", "to", "core", "whole"],
            )

    some = stored(map_arrow(keyed.select("k1", "k2", "text"), places, "k1 long, k2 long, lo int, hi int, from int, to int, core long, whole long"))
    cores = stored(repeated(some, "core", "again").where("again").drop("again"))
    known = stored(repeated(cores, "whole", "full"))
    drop_stored(some)
    drop_stored(cores)
    release(keyed.sparkSession)

    def runs(text: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[pa.Array]:
        found = Words(text, np.array([0, len(text)]), SPACED)
        at = _every(lo, hi)
        name = span_hash(WordSums(found.hash), at, at + words, 49)
        return [*(pa.array(x.astype(np.int32)) for x in (found.start[at], found.end[at + words - 1])), pa.array(signed(name))]

    open_ = _with_partners(known, "core", "whole", ["k1", "k2", "lo", "hi"])
    single = stored(_at_texts(keyed, open_, ["lo", "hi"], runs, "from int, to int, name long"))
    single = repeated(single, "name", "again").where("again")
    found = known.where("full").select("k1", "k2", "from", "to").unionByName(single.select("k1", "k2", "from", "to"))
    return found.withColumnRenamed("from", "lo")


def whole_characters(text: np.ndarray, cuts: list[dict]) -> bytes:
    """What is left beside the cuts (lo, to; ascending); each piece loses the parts of characters at its ends, and no more."""
    at, pieces = 0, []
    for c in [*cuts, {"lo": len(text), "to": len(text)}]:
        pieces.append(text[at : c["lo"]].tobytes().decode("utf-8", "ignore").encode())
        at = c["to"]
    return b"".join(pieces)


def remove_repeats(docs: DataFrame, length: int = LENGTH, window: int = WINDOW, batches: int = BATCHES, carry: tuple[str, ...] = (), passages: bool = False, words: int = PASSAGE, characters: bool = False) -> DataFrame:
    """Texts without the bytes of strings of ``length`` bytes that also start anywhere else.

    ``docs`` has doc_id (long) and text; other columns are ignored, whatever their names. All occurrences go, the first
    too; what repeats is judged on the input. Returns one row per row of ``docs``: doc_id, n_bytes, n_removed, spans
    (array of lo, to: maximal removed runs of bytes, ascending), kept (binary: a cut can split a character), repeats
    (whether the text has a string of ``length`` bytes or a run of ``words`` words that also starts elsewhere), rest (a
    struct of ``carry``). With ``passages``, such runs of words are removed as well; with ``characters``, kept loses what
    is left of a split character too.

    Null texts are empty; texts shorter than ``length`` lose nothing. Rows that repeat are copies of each other. Work per
    position is counted, never paired: names are pre-aggregated, so copies and common passages cost their own rows only.
    ``window + GRAM`` may not exceed ``length``.
    """
    keyed = _keyed(docs, carry)
    by_words = stored(repeated_passages(keyed, words, min(PASSAGE_WINDOW, words - PASSAGE_GRAM)).distinct())
    release(keyed.sparkSession)
    by_bytes = repeated_spans(keyed, length, window, batches).distinct()
    every = by_bytes.withColumn("cut", F.lit(True)).unionByName(by_words.withColumn("cut", F.lit(passages)))
    spans = stored(every.groupBy("k1", "k2").agg(F.collect_list(F.when(F.col("cut"), F.struct("lo", "to"))).alias("spans")))
    drop_stored(by_words)
    bitmap = filter_of(spans, F.col("k1").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int"))
    columns = ["doc_id", "n_bytes", "n_removed", "spans", "kept", "repeats", "rest"]
    empty = F.array().cast("array<struct<lo:int,to:int>>").alias("spans")
    length_ = F.octet_length("text").cast("long").alias("n_bytes")
    whole = _texts(keyed, bitmap, False).select("doc_id", length_, F.lit(0).cast("long").alias("n_removed"), empty, F.col("text").cast("binary").alias("kept"), F.lit(False).alias("repeats"), "rest")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = binary_parts(batch["text"])
        rows = []
        for i, found in enumerate(batch["spans"]):
            text = data[offsets[i] : offsets[i + 1]]
            own = []
            if found.is_valid and len(found.values):
                lo, to = (x.to_numpy().astype(np.int64) for x in found.values.flatten())
                order = np.argsort(lo, kind="stable")
                lo, reach = lo[order], np.maximum.accumulate(to[order])
                new = np.concatenate([[True], lo[1:] > reach[:-1]])
                ends = np.append(reach[:-1][new[1:]], reach[-1])
                own = [{"lo": int(a), "to": int(b)} for a, b in zip(lo[new], ends, strict=True)]
            keep = np.ones(len(text), dtype=bool)
            for x in own:
                keep[x["lo"] : x["to"]] = False
            kept = whole_characters(text, own) if characters and own else text[keep].tobytes()
            rows.append((len(text), int((~keep).sum()), own, kept, found.is_valid))
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("lo", pa.int32()), ("to", pa.int32())])), pa.binary(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)), batch["rest"]], columns)

    touched = map_arrow(_texts(keyed, bitmap, True).join(spans.hint("merge"), ["k1", "k2"], "left").select("doc_id", "text", "spans", "rest"), run, whole.schema)
    return touched.unionByName(whole)
