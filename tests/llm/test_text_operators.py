"""The document operators against brute force on small tables with nulls, empty texts, repeated rows and clashing columns."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from kinweave.llm.bpe import Codec, bpe_decode, bpe_encode
from kinweave.llm.decontaminate import contamination
from kinweave.llm.language_id import fit_language_id, identify_language
from kinweave.llm.licenses import license_scan
from kinweave.llm.near_dedup import near_duplicates
from kinweave.llm.suffix_dedup import remove_repeats
from kinweave.llm.toxicity import fit_toxicity, grammar, reject_toxic, score_toxicity

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, n long, kept string, bands int, spans string, score double, lang string"


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def spaced(t):
    return re.findall(r"[^\x20\x09-\x0D]+", low(t))


def alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))


def texts():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(400)] + ["été", "Über", "ñandú"]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(20, 200))] for _ in range(12)]
    out = []
    for words in base:
        for edits in (0, 0, 1, 3, 8):
            copy = list(words)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy))
    passage = " ".join(rng.choice(vocabulary) for _ in range(120))
    out += [f"{' '.join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))} {passage} {rng.choice(vocabulary)}" for _ in range(6)]
    out += [None, "", "   ", "one", "one two", "one two", "x" * 900, "ab " * 400, "A b\x0bC d", "Is onhe. " * 150, "x" * 5000]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "k", 2, "s", 0.5, "en") for i, t in enumerate(texts())]
    rows += [rows[3], rows[0], (None, "null id text", 1, "k", 2, "s", 0.5, None), (None, None, 1, "k", 2, "s", 0.5, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(docs, size):
    sets = {}
    for r in docs.collect():
        w = spaced(r["text"])
        if r["doc_id"] is not None:
            sets[r["doc_id"]] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = near_duplicates(docs, shingle=size).collect()
    assert len(got) == docs.count()
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), find(r["doc_id"]), find(r["doc_id"]) == r["doc_id"])


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(nothing(spark)).count() == 0


def removed(rows, length):
    seen: dict[bytes, int] = {}
    raw = [(t or "").encode() for t in rows]
    for b in raw:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for b in raw:
        hit = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                hit[i : i + length] = True
        out.append((len(b), int(hit.sum()), bytes(np.frombuffer(b, np.uint8)[~hit])))
    return out


def test_suffix_dedup(docs):
    rows = docs.collect()
    want = sorted((str(r["doc_id"]), *x) for r, x in zip(rows, removed([r["text"] for r in rows], 400), strict=True))
    got = remove_repeats(docs, carry=("lang", "kept")).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in got) == want
    for r in got:
        assert sum(s["to"] - s["lo"] for s in r["spans"]) == r["n_removed"] and r["rest"]["kept"] == "k"


def test_suffix_dedup_of_nothing(spark):
    assert remove_repeats(nothing(spark)).count() == 0


def test_decontamination(spark, docs):
    rng = random.Random(5)
    known = [t for t in texts() if t and len(t) > 200]
    items = [(1, " ".join(alnum(known[0])[5:40])), (2, " ".join(alnum(known[9])[:14])), (3, "one TWO"), (4, ""), (5, None), (6, " ".join(rng.choice("pqr") for _ in range(30))), (7, " ".join(alnum(known[0])[8:25]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = alnum(t)
        for at in range(max(len(w) - 12, min(len(w), 1))):
            windows.setdefault(tuple(w[at : at + 13]), set()).add(i)
    got = sorted(((str(r["doc_id"]), r["n_words"], r["n_hit"], tuple(sorted(r["item_ids"])), r["contaminated"]) for r in contamination(docs, bench).collect()))
    want = []
    for r in docs.collect():
        w, hit, found = alnum(r["text"]), set(), set()
        for k, ids in windows.items():
            for at in range(len(w) - len(k) + 1):
                if tuple(w[at : at + len(k)]) == k:
                    hit |= set(range(at, at + len(k)))
                    found |= ids
        want.append((str(r["doc_id"]), len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    assert got == sorted(want) and any(x[2] for x in want)
    assert contamination(docs, bench.limit(0)).where("n_hit > 0 or contaminated").count() == 0
    assert contamination(nothing(spark), bench).count() == 0


def test_bpe(spark, docs):
    import tiktoken

    own = Codec(open(RANKS, "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    odd = ["it's 're 'Tis don't''s", "a\n\n  b \t", "  ", "né 中文 12٣ \U0001f600\U0001f600", " x\x85y", "'s"]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(more)
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids"], r["decoded_sha256"]) for r in bpe_encode(every, RANKS, ("ids", "decoded_sha256")).collect())
    want = sorted((str(r["doc_id"]), len(ids := library.encode_ordinary(r["text"] or "")), ids, hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in every.collect())
    assert got == want
    coded = bpe_encode(more, RANKS)
    assert {r["doc_id"]: r["text"] for r in bpe_decode(coded, RANKS).collect()} == {r["doc_id"]: r["text"] for r in more.collect()}
    for r in coded.join(more, "doc_id").collect():
        for at, i in zip(r["starts"], r["ids"], strict=True):
            assert own.decode(np.array([i])).tobytes()[:1] in r["text"][at].encode()[:1] + r["text"][at].encode()
    split = spark.createDataFrame([(1, [own.ranks[b"\xc3"]]), (2, None)], "doc_id long, ids array<int>")
    assert {r["doc_id"]: (bytes(r["bytes"]), r["text"]) for r in bpe_decode(split, RANKS).collect()} == {1: (b"\xc3", "�"), 2: (b"", "")}


def test_licenses(spark):
    rows = [(1, "Released under the MIT License. Under the mit license!"), (2, "Licensed under the Apache License, Version 2.0."), (3, "licensed under the apache license 2"), (4, "CC-BY-NC 4.0"), (5, "under the mit"), (6, None), (7, ""), (8, "This work is licensed under the GNU General Public License, version 3."), (9, "GNU general public license somehow version 3")]
    got = {r["doc_id"]: r for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["phrase_starts"], got[1]["labels"], got[1]["matches"][0]["start"]) == ([1, 5], ["mit"], 0)
    assert (got[2]["phrase_starts"], got[2]["labels"]) == ([3], ["apache-2"])
    assert (got[3]["phrase_labels"], got[3]["labels"]) == ([], ["apache-2"])
    assert got[4]["labels"] == ["cc-by-nc"] and got[8]["labels"] == ["gpl-3"]
    assert all(got[i]["labels"] == [] and got[i]["score"] == 0 for i in (5, 6, 7, 9))


def test_language(spark):
    rng = random.Random(1)
    words = {"xx": ["foo", "bar", "baz"], "yy": ["über", "straße", "öde"]}
    rows = [(i, " ".join(rng.choice(words[g]) for _ in range(20)), g) for i, g in enumerate(["xx", "yy"] * 20)]
    df = spark.createDataFrame(rows + [(100, None, "xx"), (101, "12 !", None), (102, "", "yy")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in identify_language(df, fit_language_id(df)).collect()}
    assert all(got[i]["lang_pred"] == g and 0 <= got[i]["score"] <= 1 for i, _, g in rows)
    assert all(got[i]["lang_pred"] == "und" for i in (100, 101, 102))
    none = identify_language(df, fit_language_id(df.limit(0)))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}


def test_toxicity(spark):
    rng = random.Random(2)
    plain = "the river runs over old stones and people walk along it in spring".split()
    rows = []
    for i in range(400):
        w = [rng.choice(plain) for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["grobling", "snarfish", "snarfed", "grobber"]))
        rows.append((i, " ".join(w), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit_toxicity(df, df, train=F.col("doc_id") % 5 != 0)
    got = {r["doc_id"]: r["predicted"] for r in score_toxicity(df, model).collect()}
    assert sum(got[i] != y for i, _, y in rows if i % 5 == 0) <= 2
    odd = spark.createDataFrame([(1, None, "z"), (2, "", "z"), (3, "snarfish grobling you snarfed grobber", "z")], "doc_id long, text string, score string")
    assert [r["doc_id"] for r in reject_toxic(odd, model).orderBy("doc_id").collect()] == [1, 2]
    assert score_toxicity(df, fit_toxicity(df, df.where("toxic = 0"))).where("predicted = 1").count() == 0


def test_grammar_tells_clauses_apart():
    from kinweave.llm.toxicity import AIMED, INSULT, NEGATED, NEGATION, OTHER, PLAIN, REPORT, REPORTED, TARGET, THREAT, THREATENING

    s = lambda *x: grammar([(a, 1.0) for a in x])
    assert s(OTHER, INSULT)[PLAIN] == 1 and s(TARGET, OTHER, INSULT)[AIMED] == 1
    assert s(NEGATION, OTHER, INSULT)[NEGATED] == 1 and s(NEGATION, OTHER, OTHER, OTHER, INSULT)[PLAIN] == 1
    assert s(REPORT, INSULT)[REPORTED] == 1 and s(THREAT, TARGET)[THREATENING] == 1 and s(THREAT).sum() == 0


def test_toxicity_cut_is_that_of_all_rows(spark):
    """A word in all of 200 toxic and a thirteenth of 4800 clean texts: a text with it is more likely clean, sampled or not."""
    rng = random.Random(4)
    plain = "the river runs over old stones and people walk along it in spring".split()
    rows = []
    for i in range(5000):
        w = [rng.choice(plain) for _ in range(30)]
        if i % 25 == 0 or rng.random() < 1 / 13:
            w[15] = "grobling"
        rows.append((i, " ".join(w), int(i % 25 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    text = [(1, " ".join([*(plain * 3)[:15], "grobling", *(plain * 3)[15:29]]), "z")]
    odd = spark.createDataFrame(text, "doc_id long, text string, lang string")
    whole, sampled = (score_toxicity(odd, fit_toxicity(df, df, sample=n)).first() for n in (6000, 400))
    assert whole["predicted"] == sampled["predicted"] == 0
    assert abs(whole["score"] - sampled["score"]) < 0.15 and whole["score"] > 0.2
