"""Business-name normalization: each rule as a Column expression, and all of them in one Arrow function for whole tables.

Spark evaluates expressions on arrays step by step, outside generated code, which costs most of the time of a large table.
Both read the same patterns and tables, and a test holds them together.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from kinweave.functions import lexicon as L
from kinweave.functions.lexicon import HOMOGLYPHS
from kinweave.functions.text import any_of, bound, edit_distance, fix_homoglyphs, fold_ascii, joined, lookup, squash, text, words

# Patterns of identifiers in names, and of a name that is a web address.
_NOISE = [r"[\(\[]\s*(?:id|ref|no|#)\s*[:#.]?\s*\d+\s*[\)\]]", r"\b(?:id|ref)\s*[:#]\s*\d+", r"#\s*\d{2,}", r"-\s*\d{3}\s?\d{3}\b"]
_DOMAIN = r"^(?:https?://)?(?:www\.)?([a-z0-9\-]+)((?:\.[a-z]{2,6}){1,2})/?$"
# A dot goes if it follows a lone letter and another lone letter stands on its other side, or did before.
_DOTS = r"(?<=\b[a-z])\.(?=[a-z]\.)|(?<=\b[a-z]\.[a-z])\.|(?<=\.[a-z])\.(?=[a-z]?\.?)"
_LEAD, _MS = rf"^(?:(?:{'|'.join(L.HONORIFICS)})(?: |$))+", r"^m s(?: |$)"
_ALIAS = rf"\s(?:{'|'.join(re.escape(a) for a in sorted(L.ALIAS_SEPARATORS, key=len, reverse=True))})\s"
_ENDINGS = sorted({*L.TLDS, *(t.split(".")[-1] for t in L.TLDS)})


def basic_clean(c: Column) -> Column:
    """Lower case, & and + as words, id noise and apostrophes out, dotted acronyms joined, other punctuation as blanks."""
    s = F.regexp_replace(F.lower(text(c)), r"[&+]", " and ")
    for pattern in _NOISE:
        s = F.regexp_replace(s, pattern, " ")
    s = F.regexp_replace(s, "['’`´]", "")
    s = F.regexp_replace(s, _DOTS, "")
    return squash(F.regexp_replace(s, "[^a-z0-9 ]+", " "))


def collapse_legal_phrases(c: Column) -> Column:
    for phrase, form in L.LEGAL_PHRASES:
        c = F.regexp_replace(c, rf"\b{phrase}\b", form)
    return c


def strip_honorifics(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, _LEAD, ""), _MS, "")


def collapse_repeats(w: Column) -> Column:
    return F.filter(w, lambda x, i: (i == 0) | (x != F.get(w, i - 1)))


def repair_legal(w: Column) -> Column:
    """Misspelled legal words among the last three, never the first, by their neighbour or by edit distance."""
    n = F.size(w)

    def one(x: Column, i: Column) -> Column:
        follows = F.coalesce(F.get(w, i + 1), F.lit(""))
        near = (i >= F.greatest(F.lit(1), n - 3)) & (F.length(x) >= 4) & x.rlike(f"^[{''.join(L.FUZZY_LEGAL)}]") & ~any_of(x, list(L.LEGAL_FORMS))
        out = x
        for letter, (word, tag) in L.FUZZY_LEGAL.items():
            close = edit_distance(x, F.lit(word), 3) <= (2 if len(word) <= 7 else 3)
            if letter == "p":
                close = (any_of(follows, ["ltd", "limited", "ltda"]) & F.length(x).between(4, 10)) | close
            out = F.when(x.startswith(letter) & close, F.lit(tag)).otherwise(out)
        return F.when(near, out).otherwise(x)

    return F.transform(w, one)


def name_words(c: Column, native: Column | None = None) -> Column:
    """The words of one name: cleaned, legal phrases as one, look-alikes repaired, honorifics and repeats out."""
    w = F.transform(words(collapse_legal_phrases(basic_clean(c))), fix_homoglyphs)
    if native is not None:
        w = F.when(native, F.transform(w, lambda x: F.coalesce(lookup(x, L.TRANSLIT_LEGAL), x))).otherwise(w)
    return bound(bound(words(strip_honorifics(joined(w))), collapse_repeats), repair_legal)


def core_words(w: Column) -> Column:
    """Words that are no legal form; all of them if none is left."""
    return bound(F.filter(w, lambda x: ~any_of(x, list(L.LEGAL_FORMS))), lambda core: F.when(F.size(core) == 0, w).otherwise(core))


def legal_tags(w: Column) -> Column:
    return F.filter(F.transform(w, lambda x: lookup(x, L.LEGAL_FORMS)), lambda x: x.isNotNull())


def key_words(core: Column) -> Column:
    """Sorted distinct core words without generic ones; all of them if none is left."""
    key = F.array_sort(F.array_distinct(F.filter(core, lambda x: ~any_of(x, L.GENERIC_WORDS))))
    return bound(key, lambda k: F.when(F.size(k) == 0, F.array_sort(F.array_distinct(core))).otherwise(k))


def alias_pieces(c: Column) -> Column:
    """What stands between alias separators; the last piece is the name."""
    return F.filter(F.split(F.concat(F.lit(" "), c, F.lit(" ")), _ALIAS), lambda p: F.trim(p) != "")


def domain_body(c: Column) -> Column:
    """The body of a name that is a web domain (no blank in it, a known ending), else null."""
    ending = F.substring(F.regexp_extract(c, _DOMAIN, 2), 2, 100)
    return F.when(c.rlike(_DOMAIN) & any_of(ending, _ENDINGS), F.regexp_replace(F.regexp_extract(c, _DOMAIN, 1), "-", " "))


def _is_native(s: str) -> bool:
    """A letter or mark outside Latin (see text.NATIVE)."""
    return not s.isascii() and any(x > "\u024f" and not "\u1e00" <= x <= "\u1eff" and unicodedata.category(x)[0] in "LM" for x in s)


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _name_rules() -> Callable[[str, bool], list[str]]:
    """:func:`name_words` of one lower-case ASCII name, for Python; what a word becomes is kept."""
    noise, phrases = [re.compile(p, re.ASCII) for p in _NOISE], [(re.compile(rf"\b{p}\b", re.ASCII), form) for p, form in L.LEGAL_PHRASES if p != form]
    some = re.compile(rf"\b(?:{'|'.join(p for p, form in L.LEGAL_PHRASES if p != form)})\b", re.ASCII)
    dots, lead, ms = (re.compile(p, re.ASCII) for p in (_DOTS, _LEAD, _MS))
    signs, other, noisy, mixed = re.compile("[^a-z0-9 ]"), re.compile("[^a-z0-9 ]+"), re.compile(r"[(\[:#-]"), re.compile("[a-z][0-9]|[0-9][a-z]")
    ordinal, letters = re.compile("[0-9]+(?:st|nd|rd|th)"), str.maketrans(*HOMOGLYPHS)
    misspelled: dict[str, tuple[str, bool]] = {}

    def fixed(x: str) -> str:
        n, digits = sum("a" <= c <= "z" for c in x), sum("0" <= c <= "9" for c in x)
        return x.translate(letters) if n >= 3 and digits and n >= 3 * digits and not ordinal.fullmatch(x) else x

    def repaired(x: str, follows: str) -> str:
        if len(x) < 4 or x[0] not in L.FUZZY_LEGAL or x in L.LEGAL_FORMS:
            return x
        if x not in misspelled:
            word, tag = L.FUZZY_LEGAL[x[0]]
            most = 2 if len(word) <= 7 else 3
            misspelled[x] = tag, abs(len(x) - len(word)) <= most and _distance(x, word) <= most
        tag, close = misspelled[x]
        return tag if close or (x[0] == "p" and len(x) <= 10 and follows in ("ltd", "limited", "ltda")) else x

    def rules(s: str, native: bool) -> list[str]:
        if signs.search(s):
            s = s.replace("&", " and ").replace("+", " and ")
            if noisy.search(s):
                for p in noise:
                    s = p.sub(" ", s)
            s = other.sub(" ", dots.sub("", s.replace("'", "").replace("`", "")))
        s = " ".join(s.split())
        if some.search(s):
            for p, form in phrases:
                s = p.sub(form, s)
        if native or mixed.search(s):
            w = [fixed(x) for x in s.split()]
            s = " ".join([L.TRANSLIT_LEGAL.get(x, x) for x in w] if native else w)
        w = ms.sub("", lead.sub("", s)).split()
        w = [x for i, x in enumerate(w) if not i or x != w[i - 1]]
        first = max(1, len(w) - 3)
        return w[:first] + [repaired(x, follows) for x, follows in zip(w[first:], [*w[first + 1 :], ""], strict=True)] if len(w) > 1 else w

    return rules


_FIELDS = T.StructType([*(T.StructField(f, T.StringType()) for f in ("name_clean", "name_core", "name_key", "name_alt", "legal")), *(T.StructField(f, T.ByteType()) for f in ("name_translit", "name_is_domain"))])


@arrow_udf(_FIELDS)
def name_fields(c: pa.Array) -> pa.Array:
    """The fields of :func:`normalize_names` as one struct."""
    rules, alias, generic = _name_rules(), re.compile(_ALIAS, re.ASCII), set(L.GENERIC_WORDS)
    domain, known = re.compile(_DOMAIN.replace("$", r"(?=(?:\r\n|[\r\n])?\Z)"), re.ASCII), set(_ENDINGS)  # as Java ends a line
    forms, rows = L.LEGAL_FORMS, []

    def core(w: list[str]) -> list[str]:
        return [x for x in w if x not in forms] or w

    for s in c.to_pylist():
        s = s or ""
        raw = (s if s.isascii() else unicodedata.normalize("NFKC", s)).strip(" ")
        native = _is_native(raw)
        low = fold_ascii(raw).lower().strip(" ")
        found = domain.match(low) if "." in low else None
        web = found is not None and found[2][1:] in known
        pieces = [rules(p, native) for p in alias.split(f" {found[1].replace('-', ' ') if web else low} ") if p.strip(" ")]
        pieces = [w for w in pieces if w]
        main = pieces[-1] if pieces else []
        own = core(main)
        key = {x for x in own if x not in generic} or set(own)
        alts = [" ".join(core(w)) for w in pieces[:-1]]
        legal = {forms[x] for w in pieces for x in w if x in forms}
        rows.append((" ".join([forms.get(x, x) for x in main]), " ".join(own), " ".join(sorted(key)), " | ".join(alts), " ".join(sorted(legal)), native, web))
    columns = list(zip(*rows, strict=True)) or [()] * 7
    return pa.StructArray.from_arrays([*(pa.array(x, pa.string()) for x in columns[:5]), *(pa.array(x, pa.bool_()).cast(pa.int8()) for x in columns[5:])], _FIELDS.names)


def normalize_names(df: DataFrame, name: str = "business_name") -> DataFrame:
    """``df`` with name_clean, name_core, name_key, name_alt, legal, name_translit, name_is_domain; a null name is empty."""
    return df.select(*df.columns, name_fields(name).alias("_name")).select(*df.columns, "_name.*")
