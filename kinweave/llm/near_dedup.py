"""MinHash near-duplicate groups: one-permutation hashing, optimal densification, banded buckets, star-shaped candidates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm._spark import cut, filter_of, map_arrow, passes, release, slot, stored
from kinweave.llm._text import SPACED, U64, grams, mix, signed, word_chunks
from kinweave.llm.components import connected_components

#: Bins of the one-permutation sketch and rows of a band: 32 bands of 4 miss a pair at 0.8 once in 20 million.
BINS, ROWS = 128, 4
#: Places an empty bin tries for a full one before it takes the next full bin.
TRIES = 512
SHINGLE = 5
#: Sides of the rational threshold: linked if DEN * intersection >= NUM * union.
NUM, DEN = 80, 100


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a document's word hashes; the whole sequence if it is shorter."""
    return np.unique(grams(words, min(size, len(words)))) if len(words) else words[:0]


class Sketch:
    """One-permutation sketches of sorted hash sets, densified as Shrivastava (2017) describes, and their band keys."""

    def __init__(self, bins: int = BINS, rows: int = ROWS):
        self.bins, self.rows = bins, rows
        self.bounds = (np.arange(bins, dtype=U64) * U64((1 << 64) // bins)).astype(U64)
        draws = mix(np.arange(bins * TRIES, dtype=U64), 5)
        self.tries = (draws % U64(bins)).astype(np.int64).reshape(bins, TRIES)
        with np.errstate(over="ignore"):
            self.weights = mix(np.arange(bins, dtype=U64), 6) | U64(1)

    def values(self, hashes: np.ndarray) -> np.ndarray:
        """The least hash of each bin; the set is sorted and a bin is a range of hashes, so it is the first in its range."""
        at = np.searchsorted(hashes, self.bounds)
        full = np.append(at[1:], len(hashes)) > at
        out = hashes[np.minimum(at, len(hashes) - 1)].copy()
        if not full.all():
            empty = np.flatnonzero(~full)
            hit = full[self.tries[empty]]
            donor = self.tries[empty, hit.argmax(axis=1)]
            lost = ~hit.any(axis=1)
            if lost.any():
                have = np.flatnonzero(full)
                donor[lost] = have[np.searchsorted(have, empty[lost]) % len(have)]
            out[empty] = out[donor]
        return out

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.values(hashes) * self.weights).reshape(-1, self.rows).sum(axis=1, dtype=U64), 7)


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    for _, _, words in word_chunks(column, SPACED):
        for i in range(len(words)):
            yield shingle_set(words.hash[words.first[i] : words.first[i + 1]], size)


def _key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _scan(docs: DataFrame, size: int, bins: int, rows: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(bins, rows)
        counts, names, bands, lengths = [], [], [], [0]
        for s in _sets(batch["text"], size):
            counts.append(len(s))
            names.append(_key(s) if len(s) else None)
            if len(s):
                bands.append(sketch.keys(s))
            lengths.append(lengths[-1] + (bins // rows if len(s) else 0))
        keys = signed(np.concatenate(bands)) if bands else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(names, pa.binary()), pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(keys))],
            ["doc_id", "n", "set_key", "bands"],
        )

    return map_arrow(docs, run, "doc_id long, n long, set_key binary, bands array<long>")


def _set_table(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(doc_id, hashes), a row a set, of the documents in ``wanted`` (doc_id, set_key); a fixed-size filter spares the others' shuffle."""
    bitmap = filter_of(wanted, slot("doc_id"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        batch = batch.filter(pa.array(passes(bitmap, batch["place"].to_numpy())))
        if batch.num_rows:
            names, hashes = [], []
            for s in _sets(batch["text"], size):
                names.append(_key(s))
                hashes.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(names, pa.binary()), pa.array(hashes, pa.binary())], ["doc_id", "set_key", "hashes"])

    found = map_arrow(docs.select("doc_id", "text", slot("doc_id").alias("place")), run, "doc_id long, set_key binary, hashes binary")
    return found.join(wanted, ["doc_id", "set_key"], "left_semi").dropDuplicates(["doc_id", "set_key"]).select("doc_id", "hashes")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ok, last, kept = [], None, None
        for x, y in zip(batch["x"], batch["y"], strict=True):
            raw = x.as_buffer()
            if last is None or not raw.equals(last):
                last, kept = raw, np.frombuffer(raw, U64)
            other = np.frombuffer(y.as_buffer(), U64)
            if not num * max(len(kept), len(other)) <= den * min(len(kept), len(other)):
                ok.append(False)
                continue
            at = np.minimum(np.searchsorted(kept, other), len(kept) - 1)
            common = int((kept[at] == other).sum())
            ok.append(den * common >= num * (len(kept) + len(other) - common))
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    first = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y"))
    return map_arrow(pairs.join(second, "b").join(first, "a").select("a", "b", "x", "y"), run, "a long, b long")


def _open_members(members: DataFrame) -> DataFrame:
    """Members (bucket, doc_id, comp) of the buckets that still hold several components."""
    several = members.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    return members.join(several, "bucket", "left_semi")


def _shingles(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """``docs`` (doc_id, comp, area) with a row for each shingle h of theirs, and their number n."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows:
            sizes = np.array([len(x.as_buffer()) // 8 for x in batch["hashes"]], dtype=np.int64)
            flat = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in batch["hashes"]])
            row = np.repeat(np.arange(len(sizes)), sizes)
            at = pa.array(row)
            out = pa.RecordBatch.from_arrays([*(batch[c].take(at) for c in ("doc_id", "comp", "area")), pa.array(sizes[row]), pa.array(flat)], ["doc_id", "comp", "area", "n", "h"])
            for lo in range(0, len(row), 50_000):
                yield out.slice(lo, 50_000)

    return map_arrow(docs.join(sets, "doc_id").select("doc_id", "comp", "area", "hashes"), run, "doc_id long, comp long, area long, n long, h long")


def _can_link(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Documents of ``members`` that may have a link outside their component.

    A link needs an intersection of num/den of either set, so a document with fewer shingles that occur in other
    components has none: an exact rejection that costs one pass over the open documents' shingles.
    """
    shingles = _shingles(members.select("doc_id", "comp", F.lit(0).cast("long").alias("area")).distinct(), sets)
    across = shingles.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("h")
    shared = shingles.join(across, "h", "left_semi").groupBy("doc_id").agg(F.count("*").alias("c"), F.min("n").alias("n"))
    return shared.where(F.col("c") * den >= F.col("n") * num).select("doc_id")


def _across(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of ``members`` that hold every link between components, and few others: prefix filtering by area.

    Buckets that share members form areas. A document's c shingles that also occur in other components are ranked by how
    many documents of the area have them, rarest first. A link needs num/den of either set in common, so of each set the
    first c - ceil(n * num / den) + 1 are enough: linked documents meet in one of these. At their first meeting, at ranks
    i and j, they can have no more than 1 + min(cx - i, cy - j) in common; pairs for which that is too few go.
    """
    hubs = members.groupBy("bucket").agg(F.min("doc_id").alias("a"))
    areas = connected_components(members.join(hubs, "bucket").select("a", F.col("doc_id").alias("b")))
    docs = cut(members.select("doc_id", "comp").distinct().join(areas.select(F.col("node").alias("doc_id"), F.col("component").alias("area")), "doc_id"))
    shingles = stored(_shingles(docs, sets))
    uses = shingles.groupBy("area", "h").agg(F.count("*").alias("df"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    known = shingles.join(uses.where("lo <> hi").select("area", "h", "df"), ["area", "h"])
    own = Window.partitionBy("area", "doc_id", "n")
    ranked = known.withColumn("i", F.row_number().over(own.orderBy("df", "h"))).withColumn("c", F.count("*").over(own))
    need = F.floor((F.col("n") * num + (den - 1)) / den)
    prefix = stored(ranked.where(F.col("i") <= F.col("c") - need + 1).select("area", "h", "doc_id", "comp", "n", "i", "c"))
    x, y = (prefix.select(*(F.col(c).alias(c + s) for c in prefix.columns)) for s in "xy")
    fits = (F.col("doc_idx") < F.col("doc_idy")) & (F.col("compx") != F.col("compy")) & (F.least("nx", "ny") * den >= F.greatest("nx", "ny") * num)
    enough = (1 + F.least(F.col("cx") - F.col("ix"), F.col("cy") - F.col("iy"))) * (num + den) >= (F.col("nx") + F.col("ny")) * num
    met = x.join(y, (x["areax"] == y["areay"]) & (x["hx"] == y["hy"]) & fits & enough)
    return met.select(F.col("doc_idx").alias("a"), F.col("doc_idy").alias("b")).distinct()


def _same_ids(scan: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) of classes that hold rows of one doc_id with different texts."""
    rows = scan.where("n > 0 and doc_id is not null").select("doc_id", "set_key")
    several = rows.groupBy("doc_id").agg(F.min("set_key").alias("lo"), F.max("set_key").alias("hi")).where("lo <> hi").select("doc_id")
    held = rows.join(several, "doc_id", "left_semi").distinct().join(classes.select("set_key", F.col("doc_id").alias("a")), "set_key")
    return held.select("a", F.col("doc_id").alias("b")).where("a <> b").distinct()


def _placed(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members (bucket, doc_id) with their component."""
    return members.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("comp"))


def _joined(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Components after some more links."""
    if links.isEmpty():
        return groups
    return cut(connected_components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, num: int = NUM, den: int = DEN, bins: int = BINS, rows: int = ROWS) -> DataFrame:
    """Groups of near-duplicate documents.

    ``docs`` has doc_id (long) and text; other columns are ignored, whatever their names. Documents are linked if
    ``den * |A & B| >= num * |A | B|`` for their sets of ``shingle``-word shingles, and grouped by the closure.
    Returns one row per input row: doc_id, n_shingles, component_id, kept.

    * Equal sets form one class first, so copies cost a row each, however many there are.
    * Classes fall into buckets by bands of a one-permutation sketch. Each bucket proposes a star: its smallest member
      with every other. Stars are confirmed on full sets; components follow.
    * A star can miss a link between two of its leaves. Buckets that still hold several components are therefore
      finished exactly: documents that provably have no link outside their component go (see ``_can_link``), and of the
      rest the pairs that can still link are compared (see ``_across``).

    Null or empty texts have no set and are linked with nothing. Rows with a null doc_id are not linked: their
    component is null and they are kept. Rows of one doc_id are one document, with the links of all its texts and one
    component; only a row of it without words stays by itself. An empty table gives an empty result.
    """
    scan = stored(_scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle, bins, rows))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    classes = stored(scan.where("n > 0 and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.min("bands").alias("bands")))
    banded = classes.select("doc_id", F.explode("bands").alias("bucket"))
    hubs = banded.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.count("*").alias("c")).where("c > 1").select("bucket", "hub")
    hubs = stored(hubs)  # a table of its own, so that a hot bucket's side of the join can be split
    members = stored(banded.join(hubs, "bucket"))
    wanted = classes.select("doc_id", "set_key").join(members.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = stored(_set_table(source, wanted, shingle))

    star = members.where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    release(docs.sparkSession)
    groups = cut(connected_components(_verified(star, sets, num, den)))

    left = cut(_open_members(_placed(members, groups)))
    release(docs.sparkSession)
    left = cut(_open_members(left.join(_can_link(left, sets, num, den), "doc_id", "left_semi")))
    release(docs.sparkSession)
    rest = _across(left, sets, num, den).join(star, ["a", "b"], "left_anti")
    more = cut(_verified(rest, sets, num, den))
    release(docs.sparkSession)
    groups = _joined(groups, cut(more.unionByName(_same_ids(scan, classes))))

    named = (
        classes.select("set_key", "doc_id")
        .join(groups.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
        .select("set_key", F.coalesce("component", "doc_id").alias("component"))
    )
    out = scan.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")).join(named, "set_key", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )
