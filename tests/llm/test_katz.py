"""The Katz model against one written in plain Python, counts and base scores included."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import kinweave.llm.lm as lm


def good_turing(seen, most):
    n = [seen.get(r, 0) for r in range(most + 2)]
    plain = min(max(n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5, 0.1), 0.9)
    tail = (most + 1) * n[most + 1] / n[1] if n[1] else 1.0
    out = {}
    for r in range(1, most + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if n[r] and tail < 1 else 0
        out[r] = d if 0 < d < 1 else (r - plain) / r
    return out


class Plain:
    def __init__(self, texts, order, most=5):
        self.order, self.counts = order, {m: Counter() for m in range(1, order + 1)}
        for words in texts:
            s = self.marked(words)
            for t in range(order - 1, len(s)):
                for m in self.counts:
                    self.counts[m][tuple(s[t - m + 1 : t + 1])] += 1
        self.kept, self.after, self.base, self.weights = {}, {}, {}, {}
        for m, c in self.counts.items():
            d = good_turing(Counter(c.values()), most)
            self.kept[m] = {g: n * d.get(n, 1.0) for g, n in c.items()}
            for g in c:
                self.after.setdefault(g[:-1], []).append(g)
        for h, gs in self.after.items():
            whole, kept = sum(self.counts[len(h) + 1][g] for g in gs), sum(self.kept[len(h) + 1][g] for g in gs)
            self.base[h] = whole if kept < whole else whole + 1
        self.unknown = 1 - sum(self.kept[1].values()) / self.base[()] if self.counts[1] else 1.0

    def marked(self, words):
        return ["<s>"] * (self.order - 1) + words + ["</s>"]

    def p(self, g):
        if self.counts[len(g)].get(g):
            return self.kept[len(g)][g] / self.base[g[:-1]]
        return self.unknown if len(g) == 1 else self.weight(g[:-1]) * self.p(g[1:])

    def weight(self, h):
        if h not in self.weights:
            gs = self.after.get(h)
            self.weights[h] = 1.0 if not gs else max(1 - sum(self.p(g) for g in gs), 1e-12) / max(1 - sum(self.p(g[1:]) for g in gs), 1e-12)
        return self.weights[h]

    def score(self, words):
        s = self.marked(words)
        return sum(math.log10(self.p(tuple(s[t - self.order + 1 : t + 1]))) for t in range(self.order - 1, len(s)))


def thue_morse(n):
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def documents():
    rng = random.Random(1)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))), "x", 1) for i in range(150)]
    rows += [(200, None, "x", 1), (201, "", "x", 1), (None, "w1 w1 w2", "x", 1), (5, "w1 W2", "x", 1), (5, "w1 W2", "x", 1), (202, " ".join(thue_morse(10)), "x", 1)]
    return rows + [(203, "w1 " * 4000, "x", 1)]


@pytest.mark.parametrize(("order", "head", "heavy", "bucket"), [(3, lm.HEAD, lm.HEAVY, lm.BUCKET), (3, 20, 200, 100), (2, 7, lm.HEAVY, lm.BUCKET), (4, 50, 300, 150)])
def test_katz(spark, monkeypatch, order, head, heavy, bucket):
    """Few head words, many buckets and words dealt over several of them change nothing."""
    for name, value in (("HEAD", head), ("HEAVY", heavy), ("BUCKET", bucket)):
        monkeypatch.setattr(lm, name, value)
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string, blob string, bucket int").repartition(3).persist()
    got = lm.katz_scores(df, F.col("doc_id") % 7 != 2, order).collect()
    split = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
    train = [split(t) for i, t, *_ in rows if i is not None and i % 7 != 2]
    plain = Plain(train, order)
    ones = Counter(w for t in train for w in [*t, "</s>"])
    n, v = sum(ones.values()), len(ones)
    want = []
    for i, t, *_ in rows:
        w = [*split(t), "</s>"]
        want.append((str(i), len(w), sum(x in ones for x in w), n, sum(math.log10((ones[x] + 1) / (n + v + 1)) for x in w), plain.score(w[:-1])))
    have = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got)
    for a, b in zip(have, sorted(want), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)
    assert sum(r["train"] for r in got) == len(train)


def test_katz_sums_to_one():
    """After every history the probabilities of all words and the unknown one sum to one: so does the plain model."""
    plain = Plain([t.split() for t in ("a b a b c", "a b b", "c c a", "a b", "d e f g", "b a", "a c a b")], 3)
    words = [g[0] for g in plain.counts[1]]
    for h in [h for h in plain.after if len(h) == 2] + [("q", "a"), ("q", "q")]:
        assert sum(plain.p((*h, w)) for w in words) + plain.p((*h, "never")) == pytest.approx(1)


def test_katz_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert lm.katz_scores(df.limit(0), F.lit(True)).count() == 0
    assert {r["score"] for r in lm.katz_scores(df, F.lit(False)).collect()} == {0.0}


def test_discounts():
    assert all(0 < d < 1 for d in lm.discounts({1: 100, 2: 40, 3: 20, 4: 12, 5: 8, 6: 5})) and all(0 < d < 1 for d in lm.discounts({}))


def test_a_bucket_lets_go_of_what_it_no_longer_needs():
    """op2: a bucket of 1.2 million tokens is merged in under 90 MB of arrays (104 MB before they were freed early, 76 MB after)."""
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(1)
    codes, counts = lm.mix(np.arange(200_000).astype(np.uint64), 5), np.full(200_000, 9)
    known = lm.Words1(codes[:100_000], counts[:100_000], int(counts.sum()), len(codes), {1: 5000, 2: 2000, 3: 1000, 4: 700, 5: 500, 6: 400}, 5)
    rows = []
    for c in range(6):
        words, sizes = codes[np.minimum(rng.zipf(1.3, 200_000) - 1, len(codes) - 1)], np.full(400, 500)
        for _, rare, arrays in lm.Grams(words, sizes, 3, known, 1).by_bucket(known):
            arrays[-4] = np.diff(arrays[-4], prepend=0)
            rows.append({"chunk": b"%016d" % c, "blob": lm.pack(rare, *arrays, np.packbits(np.ones(400, bool)), np.array([400])), "words": None, "counts": None})
    del words, arrays, rare
    tracemalloc.start()
    out = lm._merge(0, rows, 3, 5, known, np.zeros(0, np.int64))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert out["blob"] and peak < 90
