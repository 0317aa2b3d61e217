"""The exact finish of near-dedup against brute force: leaves that stars miss, common text, ids with several texts."""

import random

from kinweave.llm.near_dedup import near_duplicates


def brute(rows, size=4):
    sets = {}
    for i, (doc, text) in enumerate(rows):
        w = (text or "").lower().split()
        sets[i] = (doc, {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set())
    root = {d: d for d, s in sets.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    full = [(d, s) for d, s in sets.values() if s]
    for i, (a, x) in enumerate(full):
        for b, y in full[:i]:
            if a == b or 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return sorted((d, len(s), find(d) if s else d) for d, s in sets.values())


def made():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"
    common = [word() for _ in range(60)]
    rows, doc = [], 0
    for _ in range(12):  # families around common text; links between edits of one family that a star can miss
        base = common[: rng.randrange(20, 60)] + [word() for _ in range(rng.randrange(4, 40))]
        for _ in range(8):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = word()
            rows.append((doc, " ".join(text)))
            doc += 1
    rows += [(doc + i, " ".join(common[:9] + [word() for _ in range(12)])) for i in range(60)]  # one passage in many documents
    rows += [(3, rows[50][1]), (70, rows[20][1]), (500, "a b c d e"), (500, rows[90][1]), (501, "a b c d e"), (502, None), (502, "lone text of its own"), (503, "")]
    return rows


def test_finish_against_brute_force(spark):
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs, shingle=4, bins=24, rows=1).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_finish_with_the_registered_bands(spark):
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs, shingle=4).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows)
