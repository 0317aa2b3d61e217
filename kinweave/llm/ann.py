"""Approximate nearest neighbours: graphs built by NN-descent (Dong et al., 2011), searched greedily.

Equal vectors are one node, whatever their number. Nodes are dealt to shards by the nearest of some pivots. A task holds a
shard's vectors in memory and builds its graph: first lists come from blocks of nodes that are near in some order, and rounds
over the neighbours of neighbours, either way, go on from there until few entries are new. A query is searched for in the
graphs of its nearest shards, from the best of a sample of their nodes. How many shards, and how broadly, is measured.
"""

from __future__ import annotations

import ctypes
import glob
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.llm._spark import drop_stored, map_arrow, release, stored, trim

#: Neighbours kept for a node, and at most so many of them, and of the nodes they are neighbours of, looked through in a round.
K, FORWARD, REVERSE = 20, 10, 6
#: Rounds go on until fewer than this share of the entries is new.
SETTLED = 0.05
#: First lists: nodes compared with each other, dealings, best kept of a block, pivots of a dealing.
BLOCK, DEALINGS, KEPT, PIVOTS = 512, 4, 10, 64
#: A shard: nodes as planned (at most twice as many), numbers in their vectors, and nodes at least where small tables are dealt to several tasks.
SHARD, NUMBERS, LEAST = 1 << 16, 1 << 23, 1 << 10
#: Search: nodes of a cell of a shard, nodes kept for a query, and those of them that are expanded; nodes for a first bound.
CELL, WIDTH, BEAM, SAMPLED = 512, 16, 8, 1024
#: Shares of a shard's cells that a query's first list is taken from, to be measured.
SHARES = (0.1, 0.2, 0.4, 0.7)
#: Visits of queries to shards that are shuffled at once.
VISITS = 1 << 24
#: Work of a visit to a shard besides the cells, in shards.
FIXED = 0.5
#: Queries that the search is measured on by an exact scan, and the recall wanted.
SAMPLE, RECALL = 256, 0.95
#: Rows handled at once within a shard.
ROWS = 256

#: Similarities are kept as whole numbers of 1 / _ONE above the _LOW bits for a row of the shard and a mark.
_ONE, _LOW = 1 << 42, 20
_ID = (1 << _LOW) - 1
#: More than float32 products of directions are off by.
_OFF = 1e-5
_NONE = np.iinfo(np.int64).min


def _vectors(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a usable vector (no null, finite, not zero, of length ``size``) and their vectors."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if column.null_count or column.flatten().null_count or (lengths != size).any():
        rows = column.to_pylist()
        at = [i for i, r in enumerate(rows) if r is not None and len(r) == size and None not in r]
        kept = column.take(pa.array(at, pa.int64()))
    else:
        at, kept = range(len(column)), column
    x = kept.flatten().to_numpy(zero_copy_only=False).reshape(len(at), size)
    ok = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    return np.array(at, dtype=np.int64)[ok], x[ok]


def _bytes(x: np.ndarray) -> pa.Array:
    """One binary value a row."""
    x = np.ascontiguousarray(x)
    offsets = pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * x.itemsize))
    return pa.Array.from_buffers(pa.binary(), len(x), [None, offsets, pa.py_buffer(x.tobytes())])


def _rows(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """The opposite of _bytes."""
    parts = []
    for part in [column] if isinstance(column, pa.Array) else column.chunks:
        if len(part):
            ends = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + len(part) + 1]
            data = part.buffers()[2]
            parts.append(np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8))
    if not parts:
        return np.zeros((0, 1), kind)
    return (parts[0] if len(parts) == 1 else np.concatenate(parts)).view(kind).reshape(len(column), -1) if sum(map(len, parts)) else np.zeros((len(column), 0), kind)


def _alone() -> None:
    """Lets numpy's bundled OpenBLAS use one thread: products are small, and every core has a task of its own."""
    for path in glob.glob(os.path.join(os.path.dirname(np.__file__), "..", "numpy.libs", "*openblas*")):
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            try:
                getattr(ctypes.CDLL(path), name)(1)
            except (AttributeError, OSError):  # another build
                continue


def _directions(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame) -> tuple[DataFrame, str]:
    """(id, raw, key): usable vectors of the table's commonest length, one an id (the least, if an id repeats); and their kind of number.

    Equal vectors have equal keys, two 64-bit hashes.
    """
    given = vectors.where("id is not null and size(vector) > 0")
    common = given.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = common["size"] if common else 1
    kind = "<f4" if isinstance(vectors.schema["vector"].dataType.elementType, T.FloatType) else "<f8"
    if kind == "<f8":
        given = given.withColumn("vector", F.col("vector").cast("array<double>"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at, x = _vectors(batch["vector"], size)
        if len(at):
            yield pa.RecordBatch.from_arrays([batch["id"].take(pa.array(at)), _bytes(x.astype(kind) + np.zeros(1, kind))], ["id", "raw"])

    one = given.where(F.size("vector") == size)
    if not one.groupBy("id").count().where("count > 1").isEmpty():
        one = one.groupBy("id").agg(F.min("vector").alias("vector"))
    made = map_arrow(one.select("id", "vector"), run, "id long, raw binary")
    return stored(made.withColumn("key", F.struct(F.xxhash64("raw").alias("a"), F.xxhash64(F.lit(1), "raw").alias("b")))), kind


def _fixed(s: np.ndarray) -> np.ndarray:
    """Similarities as whole numbers in the upper bits of 64."""
    return (s.astype(np.float64) * _ONE).astype(np.int64) << _LOW


def _least(packed: np.ndarray) -> np.ndarray:
    """The last similarity of each row."""
    return (packed[:, -1] >> _LOW) / _ONE - 2 / _ONE


def _dots(x: np.ndarray, at: np.ndarray, y: np.ndarray, row: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x[at], y[row])


def _merge(packed: np.ndarray, row: np.ndarray, add: np.ndarray, k: int) -> np.ndarray:
    """The k largest of each row of ``packed`` with the values ``add`` (sorted by their ``row``), in falling order."""
    if len(row):
        count = np.bincount(row, minlength=len(packed))
        more = np.full((len(packed), count.max()), _NONE)
        more[row, np.arange(len(row)) - (np.cumsum(count) - count)[row]] = add
        packed = np.concatenate([packed, more], axis=1)
    if packed.shape[1] > k:
        packed = np.partition(packed, packed.shape[1] - k, axis=1)[:, -k:]
    return np.sort(packed, axis=1)[:, ::-1]


def _backwards(near: np.ndarray, most: int, rng: np.random.Generator) -> np.ndarray:
    """At most ``most`` of the nodes that have a node in their list, filled up with the node itself."""
    n, k = near.shape
    to, of = near.reshape(-1), np.repeat(np.arange(n, dtype=np.int32), k)
    mixed = rng.permutation(len(to))
    mixed = mixed[np.argsort(to[mixed], kind="stable")]
    to, of = to[mixed], of[mixed]
    count = np.bincount(to, minlength=n)
    place = np.arange(len(to)) - (np.cumsum(count) - count)[to]
    out = np.repeat(np.arange(n, dtype=np.int32)[:, None], most, axis=1)
    ok = place < most
    out[to[ok], place[ok]] = of[ok]
    return out


def _first_lists(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """(similarity, neighbour, 1) packed into 64 bits: each node's best in blocks of BLOCK nodes, dealt several times.

    A dealing orders nodes by the nearest of PIVOTS of its own and then along a line of its own.
    """
    n = len(x)
    packed = np.full((n, k), _NONE)
    for _ in range(DEALINGS if n > BLOCK else 1):
        near = (x @ x[rng.integers(0, n, PIVOTS)].T).argmax(axis=1)
        order = np.lexsort((x @ rng.normal(size=x.shape[1]).astype(np.float32), near))
        for at in np.array_split(order, -(-n // BLOCK)):
            s = x[at] @ x[at].T
            np.fill_diagonal(s, -2)
            best = min(KEPT if n > BLOCK else k, len(at) - 1)
            to = np.argpartition(-s, best - 1, axis=1)[:, :best]
            p = _fixed(np.take_along_axis(s, to, axis=1)) | (at[to].astype(np.int64) << 1 | 1)
            old = packed[at]
            p[((p[:, :, None] & _ID) == (old[:, None, :] & _ID)).any(axis=2)] = _NONE
            both = np.concatenate([old, p], axis=1)
            packed[at] = np.sort(np.partition(both, both.shape[1] - k, axis=1)[:, -k:], axis=1)[:, ::-1]
    return packed


def neighbour_lists(x: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """For each row of x (directions), about its K nearest others, nearest first.

    Rounds of NN-descent go on until the lists have settled (see SETTLED), at most ``rounds`` if given.
    """
    n = len(x)
    k = min(K, n - 1)
    if k <= 0:
        return np.zeros((n, 0), np.int32)
    rng = np.random.default_rng(7)
    packed, r = _first_lists(x, k, rng), 0
    while n > BLOCK and (rounds is None or r < rounds):
        empty = packed == _NONE
        near = np.where(empty, np.arange(n)[:, None], (packed & _ID) >> 1).astype(np.int32)
        new = (packed & 1 == 1) & ~empty
        forward = near[:, :FORWARD]
        lists = np.concatenate([forward, _backwards(forward, REVERSE, rng)], axis=1)
        recent = np.concatenate([new[:, :FORWARD], np.ones((n, REVERSE), bool)], axis=1) & new.any(axis=1)[:, None]
        packed &= ~np.int64(1)
        packed[empty] = _NONE
        fresh = 0
        for lo in range(0, n, ROWS):
            v = np.arange(lo, min(n, lo + ROWS), dtype=np.int32)
            first = lists[v]
            w = np.where(recent[v][:, :, None] | recent[first], lists[first], v[:, None, None]).reshape(len(v), -1)
            every = np.sort(np.concatenate([w * 2 + 1, near[v] * 2, v[:, None] * 2], axis=1), axis=1)  # those known come first
            ok = every & 1 == 1
            ok[:, 1:] &= every[:, 1:] >> 1 != every[:, :-1] >> 1
            row, col = np.nonzero(ok)
            to = every[row, col] >> 1
            p = _fixed(_dots(x, to, x, v[row])) | (to.astype(np.int64) << 1 | 1)
            good = p > packed[v, -1][row]
            made = _merge(packed[v], row[good], p[good], k)
            packed[v] = made
            fresh += int(((made & 1 == 1) & (made != _NONE)).sum())
        r += 1
        if fresh <= SETTLED * n * k:
            break
    empty = packed == _NONE
    return np.where(empty, np.arange(n)[:, None], (packed & _ID) >> 1).astype(np.int32)


def cells_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pivots, cell of each row of x): about CELL nodes a cell, by the nearest of a sample of them."""
    n = len(x)
    pivots = x[np.sort(np.random.default_rng(3).choice(n, -(-n // CELL), replace=False))]
    cell = [(x[lo : lo + 4096] @ pivots.T).argmax(axis=1) for lo in range(0, n, 4096)]
    return pivots, np.concatenate(cell)


class Graph:
    """A shard's vectors, its lists and its cells, to be searched."""

    def __init__(self, exact: np.ndarray, near: np.ndarray):
        self.exact, x, n = exact, exact.astype(np.float32), len(exact)
        self.ways = np.concatenate([near, _backwards(near, REVERSE, np.random.default_rng(5))], axis=1) if near.shape[1] else np.zeros((n, 1), np.int32)
        self.pivots, self.cell = cells_of(x)
        order = np.argsort(self.cell, kind="stable")
        ends = np.searchsorted(self.cell[order], np.arange(len(self.pivots) + 1))
        self.members = [order[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.vectors = [np.ascontiguousarray(x[m].T) for m in self.members]
        self.sample = np.random.default_rng(4).choice(n, min(n, SAMPLED), replace=False)
        self.sampled = np.ascontiguousarray(x[self.sample].T)

    def first(self, y: np.ndarray, visited: np.ndarray) -> np.ndarray:
        """The WIDTH best of each row of y among the nodes of the cells that it visits, packed as in _first_lists."""
        width, z = min(WIDTH, len(self.exact)), y.astype(np.float32)
        least = np.full(len(y), -2.0)
        if len(self.exact) > SAMPLED:  # WIDTH nodes of the sample are at least as near
            s = np.where(visited[:, self.cell[self.sample]], z @ self.sampled, -2)
            least = np.partition(s, SAMPLED - width, axis=1)[:, SAMPLED - width] - _OFF
        packed, stages, held = np.full((len(y), width), _NONE), {-(-len(self.members) // d) for d in (16, 8, 4, 2, 1)}, []
        for c, members in enumerate(self.members):
            at = np.flatnonzero(visited[:, c])
            if len(at) and len(members):
                s = z[at] @ self.vectors[c]
                row, col = np.divmod(np.flatnonzero(s > (least[at] - _OFF).astype(np.float32)[:, None]), s.shape[1])
                if len(row) * 16 > s.size:  # many are about as near: all in double precision at once
                    s = y[at] @ self.exact[members].T
                    row, col = np.divmod(np.flatnonzero(s > least[at][:, None]), s.shape[1])
                    p = _fixed(s[row, col])
                else:
                    p = _fixed(_dots(self.exact, members[col], y, at[row]))
                held.append((at[row], p | (members[col].astype(np.int64) << 1 | 1)))
            if c + 1 in stages or sum(len(r) for r, _ in held) > 1 << 20:  # from here on with a better bound
                if held:
                    row, add = (np.concatenate(h) for h in zip(*held, strict=True))
                    order = np.argsort(row.astype(np.int16), kind="stable")
                    packed, held = _merge(packed, row[order], add[order], width), []
                    least = np.maximum(least, _least(packed))
        return packed

    def search(self, y: np.ndarray, share: float) -> np.ndarray:
        """For each row of y the WIDTH nearest rows of x found, nearest first; -1 where there are none.

        The first ones come from this share of the cells, the nearest. From them the search goes along the lists, either way,
        to nodes of other cells, until the BEAM best found have all been expanded.
        """
        n, out = len(self.exact), []
        visits = max(1, round(share * len(self.pivots)))
        for lo in range(0, len(y), ROWS * 4):
            q = y[lo : lo + ROWS * 4]
            s = q.astype(np.float32) @ self.pivots.T
            visited = s >= -np.partition(-s, visits - 1, axis=1)[:, visits - 1 : visits]
            packed = self.first(q, visited)
            walked = np.zeros(0, np.int64)
            while not visited.all():
                open_ = (packed[:, :BEAM] & 1 == 1) & (packed[:, :BEAM] != _NONE)
                row, col = np.nonzero(open_)
                if not len(row):
                    break
                node = (packed[row, col] & _ID) >> 1
                packed[row, col] &= ~np.int64(1)
                who, to = np.repeat(row, self.ways.shape[1]), self.ways[node].reshape(-1)
                ok = ~visited[who, self.cell[to]]
                flat = np.sort(who[ok] * n + to[ok])
                flat = flat[np.diff(flat, prepend=-1) != 0]
                if len(walked):
                    flat = flat[walked[np.minimum(np.searchsorted(walked, flat), len(walked) - 1)] != flat]
                walked = np.sort(np.concatenate([walked, flat]))
                who, to = np.divmod(flat, n)
                p = _fixed(_dots(self.exact, to, q, who)) | (to << 1 | 1)
                good = p > packed[who, -1]
                packed = _merge(packed, who[good], p[good], packed.shape[1])
            out.append(np.where(packed == _NONE, -1, (packed & _ID) >> 1))
        return np.concatenate(out)


class Shards:
    """How nodes are dealt to shards: by their nearest pivot and, where that has more than two shards should, by a hash of the id as well."""

    def __init__(self, nodes: DataFrame, kind: str):
        n, first = nodes.count(), nodes.first()
        size = min(SHARD, max(LEAST, NUMBERS // (len(first["raw"]) // np.dtype(kind).itemsize))) if first else SHARD
        self.kind, wanted = kind, max(-(-n // size), min(8, n // LEAST), 1)
        drawn = nodes.orderBy(F.xxhash64("id", F.lit("pivot")), "id").limit(wanted).select("raw").toArrow()
        self.pivots = _directions(_rows(drawn["raw"], kind)).astype(np.float32) if len(drawn) else np.zeros((0, 1), np.float32)
        kind, pivots = self.kind, self.pivots

        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if batch.num_rows:
                x = _directions(_rows(batch["raw"], kind)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((x @ pivots.T).argmax(axis=1).astype(np.int32))], ["id", "raw", "pivot"])

        dealt = stored(map_arrow(nodes.select("id", "raw"), run, "id long, raw binary, pivot int"))
        counts = {r["pivot"]: r["count"] for r in dealt.groupBy("pivot").count().collect()}
        parts = np.array([-(-counts.get(p, 0) // (2 * size)) for p in range(len(pivots))], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(parts)])
        begin = F.array(*[F.lit(int(b)) for b in self.begin[:-1]]) if len(parts) else F.array(F.lit(0))
        many = F.array(*[F.lit(max(1, int(b))) for b in parts]) if len(parts) else F.array(F.lit(1))
        shard = F.get(begin, F.col("pivot")) + F.pmod(F.xxhash64("id", F.lit("part")), F.get(many, F.col("pivot")))
        self.nodes = dealt.select("id", "raw", shard.cast("int").alias("shard"))
        self.stored, self.tasks = dealt, max(1, int(self.begin[-1]))

    def visits(self, queries: DataFrame, most: int | None = None) -> DataFrame:
        """(shard, place, query_id, raw): the shards of the ``most`` nearest pivots of each query (query_id, raw), place from 1."""
        kind, pivots, begin = self.kind, self.pivots, self.begin
        most = len(pivots) if most is None else most

        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if not batch.num_rows or not len(pivots):
                return
            s = _directions(_rows(batch["raw"], kind)).astype(np.float32) @ pivots.T
            order = np.argsort(-s, axis=1, kind="stable")[:, :most]
            for place in range(order.shape[1]):
                p = order[:, place]
                count = begin[p + 1] - begin[p]
                row = np.repeat(np.arange(len(p)), count)
                shard = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + begin[p][row]
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), pa.array(np.full(len(row), place + 1, np.int32)), batch["query_id"].take(at), batch["raw"].take(at)], ["shard", "place", "query_id", "raw"])

        return map_arrow(queries.select("query_id", "raw"), run, "shard int, place int, query_id long, raw binary")

    def graphs(self, visits: DataFrame, k: int, rounds: int | None = None) -> DataFrame:
        """(shard, id, raw, near): the nodes of each shard and their lists, whose entries are places in the shard in order of id.

        And, with query_id, share, place, id and score only, what a search of each of SHARES finds for some ``visits``.
        """
        kind, tasks = self.kind, self.tasks

        def build(part: pa.Table, asked: pa.Table) -> pa.Table:
            if not len(part):
                return _SHARD.empty_table()
            _alone()
            part = part.sort_by("id").combine_chunks()
            x = _directions(_rows(part["raw"], kind))
            near = neighbour_lists(x.astype(np.float32), rounds)
            tried = _look(Graph(x, near), part, asked, kind, k, SHARES)
            part = part.select(["shard", "id", "raw"]).append_column("near", _bytes(near))
            trim()
            return pa.concat_tables([part, tried], promote_options="default").select(_SHARD.names).cast(_SHARD)

        nodes, asked = self.nodes.repartition(tasks, "shard").groupBy("shard"), visits.repartition(tasks, "shard").groupBy("shard")
        return stored(nodes.cogroup(asked).applyInArrow(build, "shard int, id long, raw binary, near binary, query_id long, share double, place int, score double"))


_FOUND = pa.schema([("query_id", pa.int64()), ("share", pa.float64()), ("place", pa.int32()), ("id", pa.int64()), ("score", pa.float64())])
_SHARD = pa.schema([("shard", pa.int32()), ("id", pa.int64()), ("raw", pa.binary()), ("near", pa.binary()), *(_FOUND.field(c) for c in ("query_id", "share", "place", "score"))])


def _look(graph: Graph, part: pa.Table, asked: pa.Table, kind: str, k: int, shares: tuple[float, ...]) -> pa.Table:
    """The k + 1 nearest found in a shard for each of its visits, by each share of cells.

    Scores are cosines of the original vectors in double precision, worked out anew for all that the search has kept.
    """
    out, ids, raw = [], part["id"].to_numpy(), _rows(part["raw"], kind)
    query, place, given = asked["query_id"].to_numpy(), asked["place"].to_numpy(), _rows(asked["raw"], kind)
    for lo in range(0, len(asked), 4096):
        z = _directions(given[lo : lo + 4096])
        for share in shares:
            at = graph.search(z, share)
            for a in range(0, len(z), ROWS):
                here = at[a : a + ROWS]
                score = np.einsum("bij,bj->bi", _directions(raw[here.reshape(-1)]).reshape(*here.shape, -1), z[a : a + ROWS])
                score[here < 0] = -2
                order = np.lexsort((ids[here], -score))[:, : k + 1]
                row, col = np.nonzero(np.take_along_axis(score, order, axis=1) > -2)
                pick = order[row, col]
                out.append([query[lo + a + row], np.full(len(row), share), place[lo + a + row], ids[here[row, pick]], score[row, pick]])
    return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=_FOUND) if out else _FOUND.empty_table()


def search(graphs: DataFrame, visits: DataFrame, kind: str, k: int, share: float, tasks: int) -> DataFrame:
    """(query_id, share, place, id, score): the k + 1 nearest found of each query in each shard that it visits."""

    def look(part: pa.Table, asked: pa.Table) -> pa.Table:
        found = _FOUND.empty_table()
        if len(part) and len(asked):
            _alone()
            part = part.sort_by("id").combine_chunks()
            graph = Graph(_directions(_rows(part["raw"], kind)), _rows(part["near"], "<i4"))
            found = _look(graph, part, asked, kind, k, (share,))
        trim()
        return found

    left, right = graphs.repartition(tasks, "shard").groupBy("shard"), visits.repartition(tasks, "shard").groupBy("shard")
    return left.cogroup(right).applyInArrow(look, "query_id long, share double, place int, id long, score double")


def exact_neighbours(nodes: DataFrame, queries: DataFrame, kind: str, k: int) -> DataFrame:
    """(query_id, id, score): the k nearest of a few queries (query_id, raw), by one scan of all nodes."""
    asked = queries.select("query_id", "raw").toArrow()
    names = asked["query_id"].to_numpy()
    y = _directions(_rows(asked["raw"], kind)) if len(names) else np.zeros((0, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _alone()
        z, bound = y.astype(np.float32), np.full((len(names), k + 1), _NONE)
        for batch in batches:
            if batch.num_rows and len(names):
                ids, x = batch["id"].to_numpy(), _directions(_rows(batch["raw"], kind))
                s = z @ x.T.astype(np.float32)
                row, col = np.divmod(np.flatnonzero(s > (_least(bound) - _OFF).astype(np.float32)[:, None]), len(ids))
                score = _dots(y, row, x, col)
                bound = _merge(bound, row, _fixed(score), k + 1)  # the k + 1 best in this task so far
                ok = score > _least(bound)[row]
                row, col, score = row[ok], col[ok], score[ok]
                yield pa.RecordBatch.from_arrays([pa.array(names[row]), pa.array(ids[col]), pa.array(score)], ["query_id", "id", "score"])

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    near = nodes.select("id", "raw").mapInArrow(run, "query_id long, id long, score double").where("id <> query_id")
    return near.withColumn("r", rank).where(F.col("r") <= k).drop("r")


def measured(found: DataFrame, truth: DataFrame) -> tuple[dict[tuple[float, int], int], int]:
    """((share, place): exact neighbours found there; all exact neighbours). One as near as the last exact one counts as well."""
    worst = truth.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    hits = found.where("id <> query_id").join(worst, "query_id").where("score >= least - 1e-9")
    turn = F.row_number().over(Window.partitionBy("query_id", "share").orderBy("place", F.desc("score"), "id"))
    hits = hits.withColumn("t", turn).where("t <= n").groupBy("share", "place").count().collect()
    return {(r["share"], r["place"]): r["count"] for r in hits}, worst.agg(F.sum("n")).first()[0] or 0


def cheapest(hits: dict[tuple[float, int], int], total: int, places: int, recall: float) -> tuple[float, int]:
    """The share of cells and the number of pivots with the least work whose recall is enough; all, if none is."""
    ways = []
    for share in SHARES:
        got = np.cumsum([hits.get((share, p), 0) for p in range(1, places + 1)])
        enough = np.flatnonzero(got >= recall * total)
        if len(enough):
            ways.append(((share + FIXED) * (int(enough[0]) + 1), share, int(enough[0]) + 1))
    return min(ways)[1:] if ways else (1.0, places)


def nearest_neighbours(vectors: DataFrame, id_col: str, vector_col: str, is_query, k: int = 5, rounds: int | None = None, recall: float = RECALL) -> DataFrame:
    """The k nearest other rows, by cosine, of the rows that the condition ``is_query`` (on a column ``id``) names.

    Returns query_id, rank (from 1), id, score (cosine of the original vectors in double precision), ties to the smaller
    id. ``vectors`` may have any other columns. Vectors that are null, zero, or hold nulls or non-finite numbers take no
    part, nor do rows without an id; if an id repeats, its least vector counts. Fewer than k others give fewer rows; an
    empty table gives none. Vectors of another length than the table's commonest (the longer, if two are as common) take
    no part. Queries are rows of the index. Equal vectors are one node of a graph; of each, the k + 1 smallest ids are kept
    for answers, which is all that an answer can need.

    The search is as broad as the table needs: about SAMPLE of the queries are compared with an exact scan, and searched for
    in all shards, from several shares of their cells. All queries then take the cheapest share and number of shards whose
    recall is at least ``recall``; if there is none, all cells of all shards.
    """
    rows, kind = usable(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")))
    spark = rows.sparkSession
    names = stored(rows.groupBy("key").agg(F.min("id").alias("node"), F.count("*").alias("n")).where("n > 1").select("key", "node"))
    alike = stored(rows.select("id", "key").join(names, "key").select("node", F.col("id").alias("member"), "key"))
    first = F.row_number().over(Window.partitionBy("node").orderBy("member"))
    members = stored(alike.withColumn("r", first).where(F.col("r") <= k + 1).select(F.col("node").alias("id"), "member"))
    others = alike.where("member <> node").select(F.col("member").alias("id"))
    nodes = rows.select("id", "raw")
    if not others.isEmpty():
        nodes = stored(nodes.join(others, "id", "left_anti"))
    asked = rows.select("id").where(is_query).join(alike.select(F.col("member").alias("id"), "node"), "id", "left")
    asked = stored(asked.select(F.col("id").alias("query"), F.coalesce("node", "id").alias("node")))
    if not others.isEmpty():
        drop_stored(rows)
    release(spark)
    queries = stored(nodes.join(asked.select(F.col("node").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("query_id"), "raw"))
    pilot = stored(queries.orderBy(F.xxhash64("query_id"), "query_id").limit(SAMPLE))
    truth = stored(exact_neighbours(nodes, pilot, kind, k))
    shards = Shards(nodes, kind)
    drop_stored(nodes)
    release(spark)
    graphs = shards.graphs(shards.visits(pilot), k, rounds)
    drop_stored(shards.stored)
    release(spark)
    share, most = cheapest(*measured(graphs.where("query_id is not null"), truth), len(shards.pivots), recall)
    graph, batches = graphs.where("query_id is null").select("shard", "id", "raw", "near"), max(1, -(-queries.count() * most // VISITS))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    found = None
    for batch in range(batches):
        part = queries.where(F.pmod(F.xxhash64("query_id", F.lit("batch")), F.lit(batches)) == batch)
        near = search(graph, shards.visits(part, most), kind, k, share, shards.tasks)
        near = stored(near.withColumn("rank", rank).where(F.col("rank") <= k + 1).select("query_id", "id", "score"))
        found = near if found is None else found.unionByName(near)
        release(spark)
    drop_stored(graphs)
    release(spark)
    every = found.join(members, "id", "left").select(F.col("query_id").alias("node"), F.coalesce("member", "id").alias("other"), "score")
    answers = asked.join(every, "node").where("other <> query")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "other"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), "rank", F.col("other").alias("id"), "score")
