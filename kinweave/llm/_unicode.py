"""Code points of Arrow text and their classes."""

from __future__ import annotations

import sys

import numpy as np

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3


def per_process() -> dict:
    """A place in the worker process for tables that tasks share."""
    return sys.__dict__.setdefault("_kinweave_tables", {})


def classes() -> np.ndarray:
    """Letter, number, white space or other for every code point."""
    tables = per_process()
    if "classes" not in tables:
        import regex

        every = "".join(chr(i) if not 0xD800 <= i < 0xE000 else "!" for i in range(0x110000))
        out = np.full(0x110000, OTHER, dtype=np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, every):
                out[m.start() : m.end()] = kind
        tables["classes"] = out
    return tables["classes"]


def letters() -> np.ndarray:
    """The lower-case form of every letter (where it is one character), 32 for everything else."""
    tables = per_process()
    if "letters" not in tables:
        out = np.full(0x110000, 32, dtype=np.uint32)
        for i in np.flatnonzero(classes() == LETTER).tolist():
            low = chr(i).lower()
            out[i] = ord(low) if len(low) == 1 else i
        tables["letters"] = out
    return tables["letters"]


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 texts laid end to end, and where each text's begin."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    return np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32), np.searchsorted(lead, offsets)
