"""Text primitives as Column expressions; two need Arrow."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from kinweave.functions.lexicon import HOMOGLYPHS

#: Letters and marks outside Latin.
NATIVE = r"[\p{L}\p{M}&&[^\u0000-ɏḀ-ỿ]]"
#: Latin letters that compatibility decomposition leaves whole.
_WHOLE = str.maketrans({"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "Æ": "AE", "Œ": "OE", "Ø": "O", "Ł": "L", "Đ": "D", "þ": "th", "ð": "d", "ı": "i", "’": "'", "‘": "'", "–": "-", "—": "-"})


def text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def squash(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text(c), r"\s+", " "))


def has_native(c: Column) -> Column:
    return text(c).rlike(NATIVE)


def clean_native_token(c: Column) -> Column:
    return F.regexp_replace(text(c), r"[^\p{L}\p{M}\p{N}]", "")


def fold_ascii(s: str) -> str:
    return s if s.isascii() else unicodedata.normalize("NFKD", s.translate(_WHOLE)).encode("ascii", "ignore").decode()


@arrow_udf(T.StringType())
def to_ascii(c: pa.Array) -> pa.Array:
    """Latin letters without their marks; what has no ASCII form goes."""
    return pa.array([fold_ascii(s or "") for s in c.to_pylist()], pa.string())


@arrow_udf(T.StringType())
def nfkc(c: pa.Array) -> pa.Array:
    return pa.array([unicodedata.normalize("NFKC", s or "") for s in c.to_pylist()], pa.string())


def homoglyph_candidate(c: Column) -> Column:
    return F.translate(c, *HOMOGLYPHS)


def _count(c: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(c, f"[^{pattern}]", ""))


def fix_homoglyphs(c: Column) -> Column:
    """Look-alike digits as letters, in tokens with three letters or more and three to a digit; ordinals stay."""
    letters, digits = _count(c, "a-z"), _count(c, "0-9")
    mixed = ~c.rlike(r"^\p{L}*$") & ~c.rlike("^[0-9]*$") & ~c.rlike("^[0-9]+(st|nd|rd|th)$")
    return F.when(mixed & (letters >= 3) & (letters >= 3 * digits), homoglyph_candidate(c)).otherwise(c)


def phonetic_squeeze(c: Column) -> Column:
    """The first letter, then consonants, runs of a letter as one."""
    return F.regexp_replace(F.concat(F.substring(c, 1, 1), F.regexp_replace(F.substring(c, 2, 1_000_000), "[aeiouyhw]", "")), r"(.)\1+", "$1")


def edit_distance(a: Column, b: Column, most: int) -> Column:
    """Levenshtein distance, most + 1 beyond ``most``."""
    d = F.levenshtein(a, b, most)
    return F.when(d < 0, F.lit(most + 1)).otherwise(d)


def words(c: Column) -> Column:
    """Blank-parted words; none of an empty text."""
    return F.filter(F.split(text(c), " "), lambda w: w != "")


def joined(c: Column, by: str = " ") -> Column:
    return F.array_join(c, by)


def bound(c: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of a value that is worked out once; in a lambda, an expression is evaluated anew wherever it stands."""
    return F.get(F.transform(F.array(c), make), F.lit(0))


def any_of(c: Column, values: list[str]) -> Column:
    return c.isin(*values)


def lookup(c: Column, table: dict[str, str]) -> Column:
    """A word's entry in a fixed table, or null. A set of the words comes first: a map is searched entry by entry."""
    entries = F.str_to_map(F.lit("\n".join(f"{k}\t{v}" for k, v in table.items())), F.lit("\n"), F.lit("\t"))  # one literal
    return F.when(c.isin(*table), F.try_element_at(entries, c))


def tri_state(a: Column, b: Column) -> Column:
    """-1 if a side is empty, else whether they are equal."""
    return F.when((a == "") | (b == ""), F.lit(-1)).otherwise((a == b).cast("int"))


def jaccard(a: Column, b: Column, empty: float = -1.0) -> Column:
    """Jaccard similarity of two word lists, ``empty`` if a side has none."""
    both = F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(empty)).otherwise(both)
