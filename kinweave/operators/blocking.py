"""Blocking: features of a record, document-frequency cap, inverted-index join, ranks both ways."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.lexicon import FAMILY_WEIGHTS, NAME_STOP, STREET_TYPES
from kinweave.functions.text import any_of, phonetic_squeeze, words
from kinweave.sources.tables import materialized

#: Rank of a pair that is not in a side's top list.
ABSENT = 999
#: Classes of the first and of the second side that one task scores at a time.
LEFT, RIGHT = 16384, 131072
#: Members of a class whose lists are written out at a time, and features up to which their numbers are sent to all executors.
CHUNK, FEW = 256, 1 << 18
#: What features are made of.
CONTENT = ["name_clean", "name_core", "name_key", "name_alt", "street", "house_num", "city", "state", "locality", "unit", "addr_clean"]


def _pairs(w: Column) -> Column:
    """Neighbouring words, joined by an underscore."""
    return F.when(F.size(w) > 1, F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(1))), lambda x, i: F.concat(x, F.lit("_"), F.get(w, i + 1)))).otherwise(F.array().cast("array<string>"))


def _made(family: str, keys: Column) -> Column:
    return F.transform(keys, lambda k: F.struct(F.lit(family).alias("family"), F.concat(F.lit(f"{family}:"), k).alias("feature")))


def _one(key: Column, when: Column) -> Column:
    return F.when(when, F.array(key)).otherwise(F.array().cast("array<string>"))


def _cross(a: Column, b: Column) -> Column:
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.concat(x, F.lit("|"), y))))


def with_features(df: DataFrame) -> DataFrame:
    """Normalized records with ``made``, an array of (family, feature) in sixteen families; a feature names its family."""
    v = lambda c: F.coalesce(F.col(c), F.lit(""))
    some = lambda w: F.filter(w, lambda x: (F.length(x) > 1) & ~any_of(x, NAME_STOP))
    df = df.withColumns({"_core": words(v("name_core")), "_street": words(v("street"))})
    core, street = F.col("_core"), F.col("_street")
    alias = F.array_distinct(some(words(F.regexp_replace(v("name_alt"), r" \| ", " "))))
    staged = {
        "_names": F.slice(F.concat(some(core), F.array_except(alias, some(core))), 1, 7),
        "_named": F.slice(F.filter(street, lambda w: ~any_of(w, STREET_TYPES) & ~w.rlike(r"^\d+$") & (F.length(w) > 1)), 1, 2),
        "_unnumbered": F.filter(street, lambda w: ~w.rlike(r"^\d+$")),
    }
    df = df.withColumns(staged)
    names, named, no_number = (F.col(c) for c in staged)
    first_names = F.slice(names, 1, 5)
    city, house, unit = _one(v("city"), v("city") != ""), _one(v("house_num"), v("house_num") != ""), F.slice(words(v("unit")), 1, 1)
    state = _one(F.element_at(F.split(v("state"), r" \| "), 1), v("state") != "")
    locality = F.filter(F.slice(F.split(v("locality"), r" \| "), 1, 2), lambda x: x != "")
    letters = lambda c: F.filter(words(c), lambda w: ~any_of(w, NAME_STOP))
    initials = lambda c: _one(F.array_join(F.transform(letters(c), lambda w: F.substring(w, 1, 1)), ""), F.size(letters(c)) >= 2)
    lone = _one(v("name_core"), (F.size(core) == 1) & v("name_core").rlike(r"^\p{L}{2,5}$"))
    acronyms = F.array_distinct(F.concat(initials(v("name_clean")), initials(v("name_core")), lone))
    made = F.concat(
        _made("k", _one(v("name_key"), v("name_key") != "")),
        _made("t", names),
        _made("p", F.transform(F.filter(names, lambda w: F.length(w) >= 4), phonetic_squeeze)),
        _made("b", _pairs(core)),
        _made("ts", _cross(first_names, named)),
        _made("tc", _cross(first_names, city)),
        _made("tst", _cross(first_names, state)),
        _made("th", _cross(first_names, house)),
        _made("hs", _cross(house, named)),
        _made("hc", _cross(house, city)),
        _made("hl", _cross(house, locality)),
        _made("ae", _one(v("addr_clean"), F.length(v("addr_clean")) >= 12)),
        _made("sb", F.transform(_pairs(no_number), lambda p: F.concat(p, F.lit("|"), v("city")))),
        _made("ul", F.concat(_cross(unit, F.slice(named, 1, 1)), _cross(unit, city))),
        _made("ih", _cross(acronyms, house)),
        _made("ic", _cross(acronyms, city)),
    )
    return df.withColumn("made", made).drop("_core", "_street", *staged)


def record_features(df: DataFrame) -> DataFrame:
    """(entity_id, country, src, family, feature, times) of normalized records, in sixteen families.

    A feature that a record makes several times is kept once with their number: the first side of a match adds it up, the
    second counts it once.
    """
    long = with_features(df).select("entity_id", "country", "src", F.explode("made").alias("f")).select("entity_id", "country", "src", "f.family", "f.feature")
    return long.groupBy("entity_id", "country", "src", "family", "feature").agg(F.count("*").alias("times"))


def tag_groups(s1: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with grp: their country, or ``__other__`` where no S1 record has it (they meet every S1 record)."""
    known = s1.select("country", F.lit(True).alias("_known")).distinct()
    return targets.join(known, "country", "left").withColumn("grp", F.when(F.col("_known"), F.col("country")).otherwise("__other__")).drop("_known")


def document_frequency(features: DataFrame, by: list[str]) -> DataFrame:
    return features.select(*by, "entity_id", "feature").distinct().groupBy(*by, "feature").agg(F.count("*").alias("df"))


def frequency_cap(cap: int, percent: float = 100.0) -> int:
    """The largest document frequency kept, for a sample of ``percent`` of the records."""
    return max(5, round(cap * percent / 100))


def score_pairs(f1: DataFrame, fx: DataFrame, cap: int) -> DataFrame:
    """(s1_id, x_id, src, score): summed weight of shared features.

    ``f1`` and ``fx`` are record features, ``fx`` with grp (see :func:`tag_groups`). Features in more than ``cap`` records
    of their (src, grp) are not used: that bounds the fan-out of the join on the feature. Weights go by family and by
    ln(1 + n / df), scores are rounded to six places so that ranks do not hang on the order of a sum.
    """
    group = ["src", "grp"]
    n = fx.select(*group, "entity_id").distinct().groupBy(*group).agg(F.count("*").alias("n"))
    df = document_frequency(fx, group).where(F.col("df") <= cap).join(n, group)
    weights = F.create_map(*[F.lit(v) for kv in FAMILY_WEIGHTS.items() for v in kv])
    right = fx.select("entity_id", *group, "feature", "family").distinct().join(df, [*group, "feature"])
    right = right.select(F.col("entity_id").alias("x_id"), *group, "feature", (weights[F.col("family")] * F.log1p(F.col("n") / F.col("df"))).alias("w"))
    left = f1.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("c1"), "feature", "times")
    same = left.join(right.where("grp <> '__other__'"), (left["feature"] == right["feature"]) & (left["c1"] == right["grp"]))
    other = left.join(right.where("grp = '__other__'"), "feature")
    cols = ["s1_id", "x_id", "src", "times", "w"]
    return same.select(cols).unionByName(other.select(cols)).groupBy("s1_id", "x_id", "src").agg(F.round(F.sum(F.col("times") * F.col("w")), 6).alias("score"))


def rank_candidates(scored: DataFrame, forward: int, reverse: int) -> DataFrame:
    """Pairs in either side's top list, with both ranks (ABSENT outside a list); ties go by id."""
    fwd = F.row_number().over(Window.partitionBy("s1_id", "src").orderBy(F.desc("score"), "x_id"))
    rev = F.row_number().over(Window.partitionBy("x_id").orderBy(F.desc("score"), "s1_id"))
    ranked = scored.withColumn("f", fwd).withColumn("r", rev).where((F.col("f") <= forward) | (F.col("r") <= reverse))
    cut = lambda c, k, name: F.when(F.col(c) <= k, F.col(c)).otherwise(ABSENT).cast("int").alias(name)
    return ranked.select("s1_id", "x_id", "src", "score", cut("f", forward, "fwd_rank"), cut("r", reverse, "rev_rank"))


def _classes(records: DataFrame, groups: list[str]) -> DataFrame:
    """Records of equal content in equal ``groups`` as one row: (*groups, cls, own, members, feats).

    cls, the least id, names the class; an id with several records is a class of its own (own), with a row for each record.
    """
    content = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in CONTENT]
    w = Window.partitionBy("entity_id")
    rows = records.select("entity_id", *groups, *content).withColumn("own", F.when(F.count(F.lit(1)).over(w) > 1, F.col("entity_id")))
    if "grp" in groups:  # each record of such an id counts in all groups that the id is in
        rows = rows.withColumn("_grps", F.collect_set("grp").over(w)).withColumn("grp", F.explode(F.when(F.col("own").isNull(), F.array("grp")).otherwise(F.col("_grps"))))
    rows = rows.withColumn("_row", F.when(F.col("own").isNotNull(), F.monotonically_increasing_id()))  # each of them makes its features anew
    one = rows.groupBy("own", "_row", *groups, *CONTENT).agg(F.sort_array(F.collect_list("entity_id")).alias("members"))
    one = one.withColumn("cls", F.get("members", F.lit(0)))
    return with_features(one).select(*groups, "cls", F.col("own").isNotNull().alias("own"), "members", F.col("made.feature").alias("feats"))


def _sides(s1: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of normalized records: features of the first side's classes (view, own, cls, feature, times), their members, and the second side's classes."""
    left = materialized(_classes(s1, ["country"]))
    right = _classes(tag_groups(s1, targets), ["src", "grp"])
    plain = materialized(right.withColumn("feats", F.array_distinct("feats")))
    own = plain.where("own").groupBy("src", "grp", "cls", "own").agg(F.first("members").alias("members"), F.array_distinct(F.flatten(F.collect_list("feats"))).alias("feats"))
    right = plain.where("not own").unionByName(own)
    long = left.select(F.col("country").alias("view"), "own", "cls", F.explode("feats").alias("feature")).groupBy("view", "own", "cls", "feature").agg(F.count("*").alias("times"))
    return long, left.select("cls", "members").dropDuplicates(["cls"]), right


def _numbered(long: DataFrame, members: DataFrame, right: DataFrame, cap: int) -> tuple[DataFrame, DataFrame]:
    """Classes of either side with their features that both have, as numbers: (view, own, cls, f, t, members), (src, grp, cls, f, w, members).

    Classes of the same features are one from here on. Times of an id in several countries are summed up in the view __other__.
    """
    group = ["src", "grp"]
    n = right.where(F.size("feats") > 0).groupBy(*group).agg(F.sum(F.size("members")).alias("n"))
    df = right.select(*group, F.size("members").alias("m"), F.explode("feats").alias("feature")).groupBy(*group, "feature").agg(F.sum("m").alias("df"))
    weights = F.create_map(*[F.lit(v) for kv in FAMILY_WEIGHTS.items() for v in kv])
    df = df.where(F.col("df") <= cap).join(F.broadcast(n), group).withColumn("w", weights[F.substring_index("feature", ":", 1)] * F.log1p(F.col("n") / F.col("df")))
    long = materialized(long)
    known = df.groupBy("feature").agg(F.collect_list(F.struct(*group, "w")).alias("ws")).join(long.select("feature").distinct(), "feature", "left_semi")
    known = materialized(known.withColumn("no", F.monotonically_increasing_id()))  # the numbers have to be the same for both sides
    few = F.broadcast if known.count() <= FEW else lambda df: df
    listed = lambda c: F.sort_array(F.collect_list(F.struct("no", c)))
    own = F.filter("ws", lambda i: (i["src"] == F.col("src")) & (i["grp"] == F.col("grp")))
    x = right.select(*group, "cls", F.explode("feats").alias("feature")).join(few(known), "feature").withColumn("w", F.get(own, F.lit(0))["w"]).where("w is not null")
    x = x.groupBy(*group, "cls").agg(listed("w").alias("l")).join(right.select(*group, "cls", "own", "members"), [*group, "cls"])
    met = long.join(few(known.select("feature", "no")), "feature")
    every = met.where("own").groupBy(F.lit("__other__").alias("view"), "own", "cls", "feature", "no").agg(F.sum("times").alias("times"))
    met = met.unionByName(every).withColumn("times", F.col("times").cast("double"))
    met = met.groupBy("view", "own", "cls").agg(listed("times").alias("l")).join(members, "cls")
    merged = lambda df, by: df.groupBy(*by, F.when(F.col("own"), F.col("cls")).alias("_own"), "own", "l").agg(F.sort_array(F.flatten(F.collect_list("members"))).alias("members")).withColumn("cls", F.get("members", F.lit(0)))
    part = lambda c: F.col(f"l.{c}")
    left = merged(met, ["view"]).select("view", "own", "cls", part("no").alias("f"), part("times").alias("t"), "members")
    return left, merged(x, group).select(*group, "cls", part("no").alias("f"), part("w").alias("w"), "members")


def _flat(table: pa.Table, c: str) -> pa.Array:
    return table[c].combine_chunks() if isinstance(table[c], pa.ChunkedArray) else table[c]


def _top_members(cls: np.ndarray, at: np.ndarray, score: np.ndarray, heads: pa.ListArray, most: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The ``most`` best members of the classes ``at`` for each ``cls``, ties by id: (cls, id, score) in order."""
    offsets, ids = heads.offsets.to_numpy(), heads.values
    rank = np.empty(len(ids), np.int64)
    rank[pa.compute.sort_indices(ids).to_numpy()] = np.arange(len(ids))
    out = []
    order = np.argsort(cls, kind="stable")
    cls, at, score = cls[order], at[order], score[order]
    long = np.diff(offsets)[at]
    cut = np.searchsorted(np.cumsum(long), np.arange(0, long.sum(), 1 << 20)[1:])  # of bounded size, between classes
    cut = np.unique(np.searchsorted(cls, cls[cut[cut < len(cls)]], "left")) if len(cut) else cut
    for a, b in zip([0, *cut], [*cut, len(cls)], strict=True):
        n = long[a:b]
        member = np.repeat(offsets[at[a:b]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if b > a else np.zeros(0, np.int64)
        i, s = np.repeat(cls[a:b], n), np.repeat(score[a:b], n)
        sort = np.lexsort((rank[member], -s, i))
        i, s, member = i[sort], s[sort], member[sort]
        place = np.arange(len(i)) - np.searchsorted(i, i, "left")
        kept = place < most
        out.append((i[kept], member[kept], s[kept]))
    i, member, s = (np.concatenate(c) for c in zip(*out, strict=True))
    return i, ids.take(pa.array(member)), s


def _as_lists(side: int, i: np.ndarray, ids: pa.Array, s: np.ndarray, cls: pa.Array) -> pa.Table:
    at, first = np.unique(i, return_index=True)
    offsets = pa.array(np.append(first, len(i)).astype(np.int32))
    lists = lambda v: pa.ListArray.from_arrays(offsets, v)
    return pa.table({"side": pa.array(np.full(len(at), side, np.int32)), "cls": cls.take(pa.array(at)), "ids": lists(ids.cast(pa.string())), "scores": lists(pa.array(s.astype(np.int64)))})


def best_of_blocks(left: pa.Table, right: pa.Table, forward: int, reverse: int) -> pa.Table:
    """(side, cls, ids, scores): for each class of two blocks the best ids of the other side that share a feature, with scores in millionths.

    A class of the first side adds the weights of its features' postings; ties go by id, as in :func:`rank_candidates`.
    Classes stand in the order of their least ids, so of equal scores the first classes have the least ids.
    """
    left, right = left.sort_by("cls").combine_chunks(), right.sort_by("cls").combine_chunks()
    xs, n = _flat(right, "f"), len(right)
    features, weights = xs.flatten().to_numpy(), _flat(right, "w").flatten().to_numpy()
    of = np.repeat(np.arange(n), np.diff(xs.offsets.to_numpy()))
    order = np.argsort(features, kind="stable")
    of, weights, features = of[order], weights[order], features[order]
    mine, times, ends = _flat(left, "f").flatten().to_numpy(), _flat(left, "t").flatten().to_numpy(), _flat(left, "f").offsets.to_numpy()
    begin, end = np.searchsorted(features, mine, "left"), np.searchsorted(features, mine, "right")
    ends = ends - ends[0]
    many = np.concatenate([[0], np.cumsum(end - begin)])[ends]
    many = np.diff(many).tolist()  # postings of each class
    begin, end, ends, times = begin.tolist(), end.tolist(), ends.tolist(), times.tolist()
    summed, place = np.zeros(n), np.zeros(n, np.int64)
    top, by = np.zeros((n, reverse), np.int64), np.zeros((n, reverse), np.int64)  # millionths, and the class of the first side
    least_of = np.zeros(n, np.int64)
    rows, others, scores = [], [], []
    for i in range(len(left)):
        if not many[i]:
            continue
        hit = []
        for j in range(ends[i], ends[i + 1]):
            b, e = begin[j], end[j]
            if e > b:
                at = of[b:e]
                summed[at] += times[j] * weights[b:e]
                hit.append(at)
        if 8 * many[i] < n:  # few: read and cleared where they are
            met = np.concatenate(hit)
            count = np.arange(len(met))
            place[met] = count
            met = met[place[met] == count]
            met.sort()
            s = summed[met]
            summed[met] = 0
        else:
            met = np.flatnonzero(summed)
            s = summed[met]
            summed.fill(0)
        s = np.rint(s * 1e6).astype(np.int64)
        better = np.flatnonzero(s > least_of[met])  # an equal score goes to the smaller id, which came before
        if len(better):
            at, new = met[better], s[better]
            score, name = np.column_stack([top[at], new]), np.column_stack([by[at], np.full(len(at), i)])
            keep = np.argsort(-score, axis=1, kind="stable")[:, :reverse]
            top[at], by[at] = np.take_along_axis(score, keep, 1), np.take_along_axis(name, keep, 1)
            least_of[at] = top[at, -1]
        if len(met) > forward:
            least = np.partition(s, len(s) - forward)[len(s) - forward]
            over, equal = np.flatnonzero(s > least), np.flatnonzero(s == least)
            kept = np.concatenate([over, equal[: forward - len(over)]])
            met, s = met[kept], s[kept]
        rows.append(np.full(len(met), i))
        others.append(met)
        scores.append(s)
    joined = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)
    x, k = np.nonzero(top)
    one = _as_lists(1, *_top_members(joined(rows), joined(others), joined(scores), _flat(right, "head"), forward), _flat(left, "cls"))
    two = _as_lists(2, *_top_members(x, by[x, k], top[x, k], _flat(left, "head"), reverse), _flat(right, "cls"))
    return pa.concat_tables([one, two])


def merged_lists(lists: pa.Table, found: pa.Table) -> pa.Table:
    """Pairs (s1_id, x_id, src, score, fwd_rank, rev_rank) of rows (members, src, ids, scores) and of ``found`` (s1_id, x_id, src, score, rev_rank)."""
    members, ids, scores = (_flat(lists, c) for c in ("members", "ids", "scores"))
    m, e = np.diff(members.offsets.to_numpy()), np.diff(ids.offsets.to_numpy())
    size = m * e
    row = np.repeat(np.arange(len(size)), size)
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    entry = within % e[row] if len(row) else within
    member = members.offsets.to_numpy()[row] + (within // e[row] if len(row) else within)
    at = ids.offsets.to_numpy()[row] + entry
    both = lambda own, other: pa.chunked_array([own, *[c.cast(own.type) for c in other.chunks]]).combine_chunks()
    s1 = both(members.values.take(pa.array(member)), found["s1_id"])
    x = both(ids.values.take(pa.array(at)), found["x_id"])
    src = both(_flat(lists, "src").take(pa.array(row)), found["src"])
    micro = np.concatenate([scores.values.to_numpy()[at], found["score"].to_numpy()])
    fwd = np.concatenate([entry + 1, np.full(len(found), ABSENT)])
    rev = np.concatenate([np.full(len(row), ABSENT), found["rev_rank"].to_numpy()])
    a, b, c = (v.dictionary_encode() for v in (s1, x, src))
    code = lambda v: v.indices.to_numpy().astype(np.int64)
    key = (code(a) * max(len(b.dictionary), 1) + code(b)) * max(len(c.dictionary), 1) + code(c)
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    kept = order[first]
    low = lambda v: np.minimum.reduceat(v[order], first).astype(np.int32) if len(first) else np.zeros(0, np.int32)
    take = lambda v: v.take(pa.array(kept))
    return pa.table({"s1_id": take(s1), "x_id": take(x), "src": take(src), "score": micro[kept] / 1e6, "fwd_rank": low(fwd), "rev_rank": low(rev)})


def _ranked(left: DataFrame, right: DataFrame, forward: int, reverse: int) -> DataFrame:
    """Candidates with both ranks of numbered classes.

    No scored pair is made a row: either side's classes are dealt to blocks, each two blocks that can meet are scored in one
    task, and the lists of the best that leave it are merged by class. Only then are the lists written out for each member.
    """
    left, right = materialized(left), materialized(right)
    group = ["src", "grp"]
    blocks = lambda n, size: F.ceil(n / size).cast("long")
    dealt = lambda n: F.pmod(F.xxhash64("cls"), n)
    sizes = right.groupBy(*group).agg(blocks(F.count("*"), RIGHT).alias("nx"))
    countries = left.groupBy(F.col("view").alias("grp")).agg(F.count("*").alias("n")).where("grp <> '__other__'")
    every = left.agg(F.count("*").alias("n")).select(F.lit("__other__").alias("grp"), "n")
    sizes = sizes.join(countries.unionByName(every), "grp").where("n > 0").select(*group, "nx", blocks(F.col("n"), LEFT).alias("n1"))
    sizes = F.broadcast(materialized(sizes))
    own = left.select("view", "own", "cls", "f", "t", F.slice("members", 1, reverse).alias("head"))
    same = own.join(sizes.where("grp <> '__other__'"), F.col("view") == F.col("grp"))
    met = same.unionByName(own.where("not own or view = '__other__'").crossJoin(sizes.where("grp = '__other__'")))
    met = met.select("cls", "f", "t", "head", *group, dealt(F.col("n1")).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("nx") - 1)).alias("j"))
    x = right.select("cls", "f", "w", F.slice("members", 1, forward).alias("head"), *group).join(sizes, group)
    x = x.select("cls", "f", "w", "head", *group, dealt(F.col("nx")).alias("j"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n1") - 1)).alias("i"))
    at = [*group, "i", "j"]
    src = right.schema["src"].dataType

    def scored(a: pa.Table, b: pa.Table) -> pa.Table:
        if not (len(a) and len(b)):
            return pa.table({c: pa.array([], t) for c, t in (("side", pa.int32()), ("cls", pa.string()), ("ids", pa.list_(pa.string())), ("scores", pa.list_(pa.int64())), ("src", b.schema.field("src").type))})
        out = best_of_blocks(a, b, forward, reverse)
        return out.append_column("src", pa.array([b["src"][0].as_py()] * len(out), b.schema.field("src").type))

    found = materialized(met.groupBy(*at).cogroup(x.groupBy(*at)).applyInArrow(scored, f"side int, cls string, ids array<string>, scores array<bigint>, src {src.simpleString()}"))
    entries = F.arrays_zip(F.transform("scores", lambda s: -s).alias("o"), F.col("ids").alias("id"))
    entries = F.transform(entries, lambda e: F.struct(e["o"].alias("o"), e["id"].alias("id"), F.col("src").alias("src")))
    best = lambda most: F.slice(F.sort_array(F.flatten(F.collect_list("e"))), 1, most).alias("e")
    found = found.withColumn("e", entries)
    fwd = found.where("side = 1").groupBy("cls", "src").agg(best(forward)).select("cls", "src", F.col("e.id").alias("ids"), F.transform("e.o", lambda o: -o).alias("scores"))
    rev = found.where("side = 2").groupBy("cls").agg(best(reverse))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size("members") - 1) / CHUNK).cast("int")), lambda i: F.slice("members", i * CHUNK + 1, CHUNK))
    parts = left.select("cls", "members").dropDuplicates(["cls"]).select("cls", F.posexplode(chunks).alias("p", "members"))
    rev = rev.join(right.select("cls", "members").dropDuplicates(["cls"]), "cls").select("e", F.explode("members").alias("x_id"))
    rev = rev.select("x_id", F.posexplode("e").alias("r", "e")).select(F.col("e.id").alias("s1_id"), "x_id", "e.src", (-F.col("e.o")).alias("score"), (F.col("r") + 1).alias("rev_rank"))
    rev = rev.join(parts.select(F.col("cls").alias("c"), "p", F.explode("members").alias("s1_id")), "s1_id")
    n = (left.agg(F.sum(F.size("members"))).first()[0] or 0) * 2 * forward // (1 << 18) + 1
    bucket = lambda c: F.pmod(F.xxhash64(c, "p"), F.lit(n)).alias("b")
    lists = parts.join(fwd, "cls").select(bucket("cls"), "members", "src", "ids", "scores")
    rev = rev.select(bucket("c"), "s1_id", "x_id", "src", "score", "rev_rank")
    schema = f"s1_id string, x_id string, src {src.simpleString()}, score double, fwd_rank int, rev_rank int"
    return lists.groupBy("b").cogroup(rev.groupBy("b")).applyInArrow(lambda a, b: merged_lists(a, b), schema)


def best_pairs(f1: DataFrame, fx: DataFrame, cap: int, forward: int, reverse: int) -> DataFrame:
    """The pairs of :func:`score_pairs` that are in a top list, with their scores and ranks; :func:`rank_candidates` gives the same of them as of all."""
    f1, fx = materialized(f1), materialized(fx)
    long = f1.select(F.col("country").alias("view"), F.lit(False).alias("own"), F.col("entity_id").alias("cls"), "feature", "times")
    right = fx.groupBy("src", "grp", F.col("entity_id").alias("cls")).agg(F.collect_set("feature").alias("feats")).select("*", F.array("cls").alias("members"), F.lit(False).alias("own"))
    members = f1.select(F.col("entity_id").alias("cls")).distinct().select("cls", F.array("cls").alias("members"))
    return _ranked(*_numbered(long, members, materialized(right), cap), forward, reverse)


def best_candidates(s1: DataFrame, targets: DataFrame, cap: int, forward: int, reverse: int) -> DataFrame:
    """:func:`best_pairs` of normalized records; those of equal content are one class and scored once."""
    return _ranked(*_numbered(*_sides(s1, targets), cap), forward, reverse)


def merge_candidates(*parts: DataFrame) -> DataFrame:
    """Union of candidate tables; a pair in several keeps its best score and ranks."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("s1_id", "x_id", "src").agg(F.max("score").alias("score"), F.min("fwd_rank").alias("fwd_rank"), F.min("rev_rank").alias("rev_rank"))
