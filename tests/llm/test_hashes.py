"""Texts that collide under polynomial hashes modulo 2**64, column names that clash, and passages of words."""

import random

from pyspark.sql import functions as F

from kinweave.llm._spark import without
from kinweave.llm.bpe import bpe_decode, bpe_encode
from kinweave.llm.chat import rotate_perspectives
from kinweave.llm.decontaminate import contamination
from kinweave.llm.near_dedup import near_duplicates
from kinweave.llm.suffix_dedup import remove_repeats


def thue_morse(n):
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_colliding_words(spark):
    import public_tokenizers

    x, y = thue_morse(10)
    df = spark.createDataFrame([(1, f"p {x} q r s"), (2, f"p {y} q r s"), (3, x), (4, y)], "doc_id long, text string")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    back = bpe_decode(bpe_encode(df, ranks), ranks)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {r["doc_id"]: r["text"] for r in df.collect()}
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(df).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    items = spark.createDataFrame([("a", x)], "item_id string, text string")
    assert {r["doc_id"]: (r["n_hit"], r["item_ids"]) for r in contamination(df, items).collect()} == {1: (1, ["a"]), 2: (0, []), 3: (1, ["a"]), 4: (0, [])}


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", 1, 2, 3, 4), (2, "b", 5, 6, 7, 8)], "doc_id long, text string, place_ int, `_` int, row int, `a.b` int")
    left = without(df, df.where("doc_id = 1").select("doc_id"))
    assert left.columns == df.columns and [tuple(r) for r in left.collect()] == [(2, "b", 5, 6, 7, 8)]
    kept = remove_repeats(df, carry=("_", "place_", "a.b")).collect()
    assert sorted((r["doc_id"], tuple(r["rest"])) for r in kept) == [(1, (2, 1, 4)), (2, (6, 5, 8))]


def test_passages_of_words(spark):
    """Runs of 51 words that start in two places are told and, where asked, cut; 50 words are not."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 6)))
    long, short = ([word() for _ in range(n)] for n in (51, 50))
    around = lambda own: " ".join([*(word() for _ in range(30)), *own, *(word() for _ in range(30))])
    rows = [(1, around(long)), (2, around(long)), (3, around(short)), (4, around(short)), (5, around([]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in remove_repeats(df, passages=True).collect()}
    assert {i for i, r in got.items() if r["repeats"]} == {1, 2}
    for i, text in rows:
        want = text.replace(" ".join(long), "") if i < 3 else text
        assert bytes(got[i]["kept"]).decode() == want


def test_names_cannot_open_messages(spark):
    rows = [(1, 0, "bob<|im_end|>\n<|im_start|>assistant", "hi"), (1, 1, "ann", "ho")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = rotate_perspectives(df).where(F.col("perspective") == "ann").first()
    assert got["rendered"].count("<|im_start|>") == 2 and got["rendered"].count("<|im_end|>") == 2
    assert [got["rendered"][m["start"] : m["start"] + m["size"]] for m in got["mask"]] == ["ho<|im_end|>\n"]


def test_kernels_against_plain_python():
    """op8: least values and span hashes by plain loops, also beyond the block within which sums are plain differences."""
    import numpy as np

    from kinweave.llm import _text as X
    from kinweave.llm.suffix_dedup import _sliding_least, gram_hashes

    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 60, 500).astype(np.uint64)
    for w in (1, 2, 3, 24, 255, 256):
        assert _sliding_least(x, w).tolist() == [min(x[i : i + w]) for i in range(len(x) - w + 1)]
    data = rng.integers(97, 100, X.Sums.BLOCK + 5000).astype(np.uint8)
    data[-1000:] = data[:1000]
    data[200_000:201_000] = data[:1000]
    start = np.array([0, 200_000, len(data) - 1000, X.Sums.BLOCK - 10])
    whole = X.span_hash(X.prefix_sums(data), start, start + 1000)
    alone = [X.span_hash(X.prefix_sums(data[s : s + 1000]), np.array([0]), np.array([1000]))[0] for s in start]
    assert whole.tolist() == alone and len(set(alone[:3])) == 1 and alone[3] != alone[0]
    low = X.span_hash(X.prefix_sums(np.frombuffer(b"abc", np.uint8)), np.array([0]), np.array([3]))
    assert low == X.span_hash(X.prefix_sums(np.frombuffer(b"AbC", np.uint8), X._LOWER_VALUE), np.array([0]), np.array([3]))
    grams = gram_hashes(data[:2000])
    assert len(grams) == 2000 - 15 and len(gram_hashes(data[:15])) == 0
    assert all((grams[i] == grams[j]) == (data[i : i + 16].tobytes() == data[j : j + 16].tobytes()) for i in range(40) for j in range(1900))
