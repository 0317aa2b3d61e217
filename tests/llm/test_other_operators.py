"""Nearest neighbours, chat perspectives, the pipeline and the registry."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave.llm.ann import SHARES, Graph, cheapest, nearest_neighbours, neighbour_lists
from kinweave.llm.chat import rotate_perspectives

DATA = "/root/testdata/sf0.001"


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 16))
    x[7] = x[8]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    bad = [(500, None), (550, [0.0] * 16), (600, [float("nan")] * 16), (650, [None] + [1.0] * 15), (None, [1.0] * 16), rows[3]]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    got: dict = {}
    for r in nearest_neighbours(df, "vec_id", "embedding", F.col("id") % 50 == 0, rounds=4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 300, 50):
        c = u @ u[q]
        c[q] = -2
        best = sorted(range(300), key=lambda i: (-c[i], i))[:5]
        mine = sorted(got[q])
        assert [r for r, *_ in mine] == [1, 2, 3, 4, 5]
        assert all(s == pytest.approx(c[i], abs=1e-12) for _, i, s in mine)
        hit += len(set(best) & {i for _, i, _ in mine})
    assert set(got) == set(range(0, 300, 50)) and hit >= 27
    few = nearest_neighbours(df.where("vec_id < 3"), "vec_id", "embedding", F.col("id") == 0, rounds=1)
    assert few.count() == 2 and nearest_neighbours(df.limit(0), "vec_id", "embedding", F.col("id") == 0, rounds=1).count() == 0


def test_nearest_neighbours_beam_grows(spark):
    """Directions without structure, which a fixed beam and fixed rounds lose: the measured recall still holds."""
    x = np.random.default_rng(4).normal(size=(3000, 128))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in nearest_neighbours(df, "vec_id", "embedding", F.col("id") % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["id"])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 3000, 50):
        c = u @ u[q]
        c[q] = -2
        hit += len(got[q] & set(np.argsort(-c)[:5].tolist()))
    assert len(got) == 60 and hit >= 0.95 * 300


def test_nearest_neighbours_takes_few_jobs(spark):
    """Graphs are built and searched in tasks: no jobs for each round or step, whose shuffles held a vector for each edge."""
    x = np.random.default_rng(6).normal(size=(3000, 16))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    spark.sparkContext.setJobGroup("few jobs", "")
    assert nearest_neighbours(df, "vec_id", "embedding", F.col("id") % 50 == 0).count() == 300
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("few jobs")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(jobs) < 60


def test_nearest_neighbours_in_clusters(spark):
    """A tight cluster, and equal vectors beyond what an answer holds: ties go to the smaller id."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(1000, 32)), rng.normal(size=32) + 1e-3 * rng.normal(size=(1000, 32))])
    x = np.concatenate([x, np.tile(x[5], (200, 1))]).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got: dict = {}
    for r in nearest_neighbours(df, "vec_id", "embedding", F.col("id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hit = 0
    for q in range(0, 2200, 50):
        c = u @ u[q]
        c[q] = -2
        mine = [i for _, i, _ in sorted(got[q])]
        assert all(s == pytest.approx(c[i], abs=1e-12) for _, i, s in got[q])
        hit += sum(c[i] >= np.sort(c)[-5] - 1e-12 for i in mine)
        if q >= 2000:
            assert mine == ([5, 2000, 2001, 2002, 2003] if q > 2003 else [5, 2001, 2002, 2003, 2004])
    assert len(got) == 44 and hit >= 0.9 * 220


def test_nearest_neighbours_in_batches(spark, monkeypatch):
    """Queries searched for in several batches, so that their visits fit the disk, get the same rows."""
    x = np.random.default_rng(9).normal(size=(2500, 8))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")

    def rows():
        return sorted(map(tuple, nearest_neighbours(df, "vec_id", "embedding", F.col("id") % 50 == 0).collect()))

    whole = rows()
    monkeypatch.setattr("kinweave.llm.ann.VISITS", 20)
    assert len(whole) == 250 and rows() == whole


def test_neighbour_graph_and_search():
    """Rounds better the first lists; going along the lists betters what the nearest cells hold; all cells are exact."""
    x = np.random.default_rng(3).normal(size=(6000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = []
    for v in range(0, 6000, 20):
        c = x @ x[v]
        c[v] = -2
        true.append(set(np.argsort(-c)[:6].tolist()))

    def recall(lists):
        return np.mean([len(t & set(lists[i].tolist())) / 6 for i, t in enumerate(true)])

    lists = neighbour_lists(x.astype(np.float32))
    assert recall(lists[::20]) > recall(neighbour_lists(x.astype(np.float32), 0)[::20]) + 0.05
    assert (lists != np.arange(6000)[:, None]).all() and all(len(set(r)) == lists.shape[1] for r in lists.tolist())
    y, along, alone = x[::20], Graph(x, lists), Graph(x, lists[:, :0])
    assert recall(along.search(y, 0.2)) > recall(alone.search(y, 0.2)) + 0.05
    assert recall(along.search(y, 1.0)) == 1


def test_search_is_as_broad_as_measured():
    hits = {(0.1, 1): 50, (0.1, 2): 30, (0.4, 1): 80, (0.4, 2): 15}
    assert cheapest(hits, 100, 3, 0.75) == (0.4, 1) and cheapest(hits, 100, 3, 0.9) == (0.4, 2)
    assert cheapest(hits, 100, 3, 0.99) == (1.0, 3) and cheapest({}, 0, 3, 0.9)[0] == SHARES[0]


def test_nearest_neighbours_of_ragged_vectors(spark):
    """The table's commonest length counts, wherever longer and shorter rows stand and if an id has both."""
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(np.random.default_rng(2).normal(size=(40, 8)))]
    ragged = [(100, [1.0] * 12), (110, [1.0] * 3), (0, [-9.0] * 3), (120, [])]
    df = spark.createDataFrame(rows + ragged, "vec_id long, embedding array<double>").coalesce(1)
    got, want = (sorted(map(tuple, nearest_neighbours(x, "vec_id", "embedding", F.col("id") % 10 == 0, rounds=1).collect())) for x in (df, df.where("size(embedding) = 8")))
    assert got == want and {r[0] for r in got} == {0, 10, 20, 30} and len(got) == 20


def test_perspectives(spark):
    rows = [(1, 0, "ann", "hi"), (1, 1, "bob", None), (1, 2, "ann", "x<|im_end|>"), (2, 0, None, "z"), (None, 0, "ann", "no")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["perspective"]): r for r in rotate_perspectives(df).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (2, "unknown")}
    a = got[1, "ann"]
    assert [a["rendered"][m["start"] : m["start"] + m["size"]] for m in a["mask"]] == ["hi<|im_end|>\n", "x<\\|im_end|><|im_end|>\n"]
    assert "user name=bob" in a["rendered"] and a["n_masked"] == sum(m["size"] for m in a["mask"]) and got[1, "bob"]["n_own"] == 1
    assert rotate_perspectives(df.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_pipeline(spark):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    ids = {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, DATA).persist()
        assert out.columns == docs.columns
        now = {r[0] for r in out.select("doc_id").collect()}
        assert now <= ids and len(now) > 100, name
        docs, ids = out, now
    last = C.STAGES[-1][1](spark, docs, DATA)
    assert {r[0] for r in last.select("doc_id").collect()} == ids


def test_suffix_dedup_cuts_whole_characters(spark):
    """U+FFFD of the text itself stays, and halves of split characters go even where two would make a character."""
    import corpus_pipeline as C

    same = "\u00a9" + "xyz" * 150 + "\u00c3"  # shares the last byte of U+00E9 before it and the first of U+00E9 after it
    rows = [(1, "a\ufffdb\u00e9" + same[1:-1] + "\u00e9c\ufffd"), (2, "q\u00a9" + same[1:-1] + "\u00ebr"), (3, "\ufffdalone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in C.suffix_dedup(spark, df, "").collect()}
    assert got == {1: "a\ufffdbc\ufffd", 2: "qr", 3: "\ufffdalone"}


def test_registry():
    import __spark_entry__ as E

    names = list(E.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert set(E.oracle_sql()) <= set(names)
