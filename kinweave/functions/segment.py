"""Word segmentation by word frequencies, and vocabulary-confirmed repairs of single words."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.functions import arrow_udf

LONGEST = 20


class Segmenter:
    """The likeliest cut of a string into words of a vocabulary; a word costs -ln of its share, others by their length."""

    def __init__(self, counts: dict[str, int]):
        total = sum(counts.values()) or 1
        self.cost = {w: math.log(total / c) for w, c in counts.items() if len(w) > 1 or w == "a"}
        self.letter = math.log(total) + 5

    def price(self, w: str) -> float:
        return self.cost.get(w, self.letter * len(w))

    def split(self, s: str) -> list[str]:
        best: list[tuple[float, int]] = [(0.0, 0)]
        for end in range(1, len(s) + 1):
            starts = range(max(0, end - LONGEST), end)
            best.append(min(((best[a][0] + self.price(s[a:end]), a) for a in starts), key=lambda x: (x[0], x[1])))
        out, end = [], len(s)
        while end:
            out.append(s[best[end][1] : end])
            end = best[end][1]
        return out[::-1]

    def repair(self, w: str) -> list[str]:
        """Look-alike digits as letters where that is a far commoner word; glued words apart where the parts are likelier."""
        if len(w) >= 3 and not w.isalpha() and not w.isdigit() and sum(c.isalpha() for c in w) >= 2:
            other = w.translate(str.maketrans("0134578@$", "oleastbas"))
            if other.isalpha() and self.cost.get(other, math.inf) < self.cost.get(w, math.inf) - 2:
                w = other
        if len(w) >= 10 and not w.isdigit():
            parts = self.split(w)
            if len(parts) > 1 and all(p in self.cost for p in parts) and sum(map(self.price, parts)) < self.cost.get(w, math.inf):
                return parts
        return [w]


def repair_udf(vocabulary: DataFrame):
    """An Arrow function that repairs blank-parted words. ``vocabulary`` (token, n) is bounded by its own limit and broadcast."""
    table = vocabulary.toArrow()
    shared = vocabulary.sparkSession.sparkContext.broadcast(dict(zip(table["token"].to_pylist(), table["n"].to_pylist(), strict=True)))

    @arrow_udf("string")
    def repaired(c: pa.Array) -> pa.Array:
        own = Segmenter(shared.value)
        return pa.array([" ".join(x for w in (s or "").split() for x in own.repair(w)) for s in c.to_pylist()], pa.string())

    return repaired
