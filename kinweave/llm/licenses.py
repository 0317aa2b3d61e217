"""License scans: templates with optional and replaceable regions, compiled to token automata."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinweave.llm._spark import map_arrow
from kinweave.llm._text import ALNUM, U64, Words, grams, word_chunks

#: Plain phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Markup: <<optional>> ... <<end>> may be absent, <<var n>> stands for up to n words of any kind.
TEMPLATES = {
    "mit": [
        "<<optional>> released <<end>> under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files <<optional>> the software <<end>> to deal in the software without restriction",
    ],
    "apache-2": ["licensed under the apache license <<optional>> version <<end>> 2 <<optional>> 0 <<end>> <<optional>> the license <<end>>"],
    "cc-by-nc": ["<<optional>> licensed under <<optional>> the <<end>> <<end>> cc by nc <<optional>> <<var 1>> 0 <<end>>", "creative commons attribution noncommercial <<optional>> <<var 1>> 0 <<end>> <<optional>> international <<end>> license"],
    "cc-by": ["creative commons attribution <<optional>> <<var 1>> 0 <<end>> <<optional>> international <<end>> license"],
    "gpl-3": [
        "<<optional>> this work is <<end>> licensed under the gnu general public license <<optional>> as published by the free software foundation <<end>> <<optional>> either <<end>> version 3",
        "gnu general public license <<optional>> as published by the free software foundation <<end>> <<optional>> either <<end>> version 3",
    ],
    "bsd-3": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met <<var 90>> neither the name of <<var 12>> nor the names of its contributors may be used"],
}


def word_hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return Words(raw, np.array([0, len(raw)]), ALNUM).hash


def _parse(markup: str) -> list:
    """Nested list of words, ("optional", [...]) and ("var", most)."""
    stack: list[list] = [[]]
    for piece in re.findall(r"<<[^>]*>>|[^\s<]+", markup):
        if piece == "<<optional>>":
            stack.append([])
        elif piece == "<<end>>":
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        elif piece.startswith("<<var"):
            stack[-1].append(("var", int(piece[5:-2])))
        else:
            stack[-1].append(piece)
    if len(stack) != 1:
        raise ValueError(f"<<optional>> without <<end>>: {markup}")
    return stack[0]


class Automaton:
    """Accepts the word sequences of a piece of markup; states are numbers, the last one accepts."""

    def __init__(self, nodes: list, backwards: bool = False):
        self.moves: list[list[tuple[int | None, int]]] = [[]]
        self.skips: list[list[int]] = [[]]
        self.last = self._add(nodes, 0, backwards)

    def _state(self) -> int:
        self.moves.append([])
        self.skips.append([])
        return len(self.moves) - 1

    def _add(self, nodes: list, at: int, backwards: bool) -> int:
        for node in reversed(nodes) if backwards else nodes:
            if isinstance(node, str):
                to = self._state()
                self.moves[at].append((int(word_hashes(node)[0]), to))
            elif node[0] == "optional":
                inner = self._add(node[1], at, backwards)
                to = self._state()
                self.skips[inner].append(to)
                self.skips[at].append(to)
            else:
                ends, here = [at], at
                for _ in range(node[1]):
                    step = self._state()
                    self.moves[here].append((None, step))
                    here = step
                    ends.append(here)
                to = self._state()
                for x in ends:
                    self.skips[x].append(to)
            at = to
        return at

    def _closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for x in self.skips[todo.pop()]:
                if x not in states:
                    states.add(x)
                    todo.append(x)
        return states

    def longest(self, words) -> int:
        """Words of the longest accepted beginning of ``words``, or -1."""
        states, best = self._closure({0}), -1
        if self.last in states:
            best = 0
        for n, w in enumerate(words, 1):
            states = self._closure({to for s in states for want, to in self.moves[s] if want is None or want == w})
            if not states:
                break
            if self.last in states:
                best = n
        return best


class Template:
    """A template around its anchor, the first run of mandatory words: what stands before is matched leftwards, what follows rightwards."""

    def __init__(self, label: str, markup: str):
        nodes = _parse(markup)
        anchors = [i for i in range(len(nodes) - 2) if all(isinstance(x, str) for x in nodes[i : i + 3])]
        if not anchors:
            raise ValueError(f"a template needs three mandatory words in a row: {markup}")
        lo = anchors[0]
        self.label = label
        self.anchor = int(grams(word_hashes(" ".join(nodes[lo : lo + 3])), 3)[0])
        self.head, self.tail = Automaton(nodes[:lo], backwards=True), Automaton(nodes[lo + 3 :])
        self.mandatory = sum(isinstance(x, str) for x in nodes)
        self.reach = len(self.head.moves), len(self.tail.moves)

    def match(self, words: np.ndarray, at: int) -> tuple[int, int] | None:
        """(first word, words) of the longest match whose anchor begins at ``at``."""
        before = self.head.longest(words[max(0, at - self.reach[0]) : at][::-1].tolist())
        after = self.tail.longest(words[at + 3 : at + 3 + self.reach[1]].tolist())
        return None if before < 0 or after < 0 else (at - before, before + 3 + after)


def license_scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """License statements in whole texts.

    ``docs`` has doc_id and text; other columns are ignored. Returns one row per row: doc_id, n_words, phrase_starts
    (array of start words of every phrase, ascending), phrase_labels, matches (array of label, start, size: template
    matches), labels (phrases and templates), score: 0 without a label, else m / (m + 1) for the mandatory words m of
    the longest statement found.

    A template's anchor, three mandatory words, is looked up for all words of a batch at once; automata run at anchors
    only. Null and empty texts have no words and no labels. Scan only: no shuffle.
    """
    phrases, templates = PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates
    for label, texts in templates.items():
        for markup in texts:
            Template(label, markup)  # faulty markup is told here, not by the workers

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        compiled = [Template(label, markup) for label, texts in templates.items() for markup in texts]
        plain = [(word_hashes(p), label) for p, label in phrases.items()]
        heads = {int(grams(h[:3], len(h[:3]))[0]) for h, _ in plain} | {t.anchor for t in compiled}
        wanted = np.array(sorted(heads), dtype=U64)
        short = {len(h) for h, _ in plain if len(h) < 3}
        for lo, hi, words in word_chunks(batch["text"], ALNUM):
            rows: list[tuple] = []
            g = grams(words.hash, 3)
            found = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, g), len(wanted) - 1)] == g)
            for n in short:
                x = grams(words.hash, n)
                found = np.union1d(found, np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, x), len(wanted) - 1)] == x))
            bounds = np.searchsorted(found, words.first)
            for i in range(hi - lo):
                own, starts, base, matches, best = words.hash[words.first[i] : words.first[i + 1]], [], set(), [], 0
                for at in (found[bounds[i] : bounds[i + 1]] - words.first[i]).tolist():
                    for h, label in plain:
                        if at + len(h) <= len(own) and (own[at : at + len(h)] == h).all():
                            starts.append(at)
                            base.add(label)
                            best = max(best, len(h))
                    if at + 3 <= len(own):
                        head = int(g[at + words.first[i]])
                        for t in compiled:
                            if t.anchor == head and (m := t.match(own, at)):
                                matches.append({"label": t.label, "start": m[0], "size": m[1]})
                                best = max(best, t.mandatory)
                rows.append((len(own), starts, sorted(base), matches, sorted(base | {m["label"] for m in matches}), best / (best + 1)))
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("size", pa.int64())])), pa.list_(pa.string()), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].slice(lo, hi - lo), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))],
                ["doc_id", "n_words", "phrase_starts", "phrase_labels", "matches", "labels", "score"],
            )

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, n_words long, phrase_starts array<long>, phrase_labels array<string>, matches array<struct<label:string,start:long,size:long>>, labels array<string>, score double")
