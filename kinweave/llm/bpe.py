"""Byte-level BPE over Arrow batches, with the tokenizers library.

Texts are cut into the pattern's matches by array operations on code points; only the distinct matches of a batch reach
the library, and their ids are gathered back into the texts. Decoding reverses the byte table on raw bytes, so characters
split over several tokens come together again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinweave.llm._spark import map_arrow, trim
from kinweave.llm._text import binary_parts, chunks, prefix_sums, span_hash
from kinweave.llm._unicode import SPACE, classes, per_process

#: Words handed to the library at once.
BLOCK = 20_000


def byte_chars() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: lines of base64 and number."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line.strip())}


def same_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, of: np.ndarray) -> bool:
    """Whether each word has the bytes of the word that ``of`` names."""
    size = end - start
    if not (size == size[of]).all():
        return False
    at = np.arange(len(data)) - np.repeat(start, size)
    return bool((data == data[np.repeat(start[of], size) + at]).all())


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer, models

        self.ranks = read_ranks(content)
        chars = byte_chars()

        def printable(token: bytes) -> str:
            return "".join(chars[b] for b in token)

        # Any two tokens that join to a token may merge, at that token's rank.
        merges = [(printable(t[:i]), printable(t[i:])) for t in sorted(self.ranks, key=self.ranks.__getitem__) for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.library = Tokenizer(models.BPE(vocab={printable(t): r for t, r in self.ranks.items()}, merges=merges, ignore_merges=True))
        self.table = str.maketrans({chr(b): chars[b] for b in range(256)})
        by_id = sorted((r, t) for t, r in self.ranks.items())
        self.sizes = np.zeros(by_id[-1][0] + 1, dtype=np.int64)
        for r, t in by_id:
            self.sizes[r] = len(t)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.bytes = np.frombuffer(b"".join(t for _, t in by_id), dtype=np.uint8)
        self.classes = classes()
        del merges, by_id
        trim()  # the merges took much more than what is left

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of separate words, and where each word's begin."""
        ids, counts = [], []
        for at in range(0, len(words), BLOCK):
            block = [w.decode("latin-1").translate(self.table) for w in words[at : at + BLOCK]]
            code = self.library.encode(block, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(code.ids, dtype=np.uint32))
            counts.append(np.bincount(np.array(code.word_ids, dtype=np.int64), minlength=len(block)))
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32), np.concatenate([[0], *[np.cumsum(np.concatenate(counts))]]) if counts else np.zeros(1, np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts data[offsets[i]:offsets[i+1]], and where each text's begin."""
        start = self.cuts(data, offsets)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        end = np.append(start[1:], len(data))
        raw = data.tobytes()
        _, first, which = np.unique(span_hash(prefix_sums(data), start, end), return_index=True, return_inverse=True)
        if not same_words(data, start, end, first[which]):  # two words with one hash: then each is its own
            first = which = np.arange(len(start))
        ids, begin = self.words([raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)])
        count = np.diff(begin)[which]
        total = np.concatenate([[0], np.cumsum(count)])
        flat = ids[np.repeat(begin[which] - total[:-1], count) + np.arange(total[-1])]
        return flat, total[np.searchsorted(start, offsets)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids stand for."""
        size = self.sizes[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.bytes[np.repeat(self.starts[ids] - total[:-1], size) + np.arange(total[-1])]

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte positions at which the pattern's matches begin; matches never cross texts."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int64)
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
        chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        kind = self.classes[chars]
        m = len(chars)
        text = np.zeros(m + 1, dtype=bool)  # a text begins
        text[np.searchsorted(lead, offsets)] = True
        begin = text[:-1].copy()
        begin[1:] |= kind[1:] != kind[:-1]
        # The last space before something else leaves its run; a blank joins what follows.
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~text[1:-1])
        begin[last] = True
        begin[last[chars[last] == 0x20] + 1] = False
        # Contractions, where a match begins at the apostrophe.
        quote = np.flatnonzero((chars[:-1] == 0x27) & begin[:-1] & ~text[1:-1])
        if len(quote):
            one = chars[quote + 1]
            two = np.where((quote + 2 < m) & ~text[np.minimum(quote + 2, m)], chars[np.minimum(quote + 2, m - 1)], 0)
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
            for which, size in ((short, 2), (long, 3)):
                at = quote[which]
                begin[at + 1] = False
                after = at[at + size < m] + size
                begin[after] = True
        return lead[np.flatnonzero(begin)]


def codec(content: bytes) -> Codec:
    """The process's codec of a rank file."""
    name = ("codec", hashlib.blake2b(content).digest())
    tables = per_process()
    if name not in tables:
        tables[name] = Codec(content)
    return tables[name]


def token_starts(codec_: Codec, ids: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The character in which each token begins (one split over tokens counts for all of them)."""
    at = np.concatenate([[0], np.cumsum(codec_.sizes[ids])[:-1]]) if len(ids) else np.zeros(0, np.int64)
    return (np.cumsum((data & 0xC0) != 0x80) - 1)[at]


COLUMNS = {"ids": "array<int>", "starts": "array<int>", "ids_sha256": "string", "decoded_sha256": "string"}


def bpe_encode(docs: DataFrame, ranks_path: str, columns: tuple[str, ...] = ("ids", "starts")) -> DataFrame:
    """Byte-level BPE ids of whole texts, without special tokens.

    ``docs`` has doc_id and text; other columns are ignored. Returns one row per row: doc_id, n_tokens and ``columns``:
    ids, starts (the character in which each token begins), ids_sha256 (of the ids as little-endian 32-bit numbers),
    decoded_sha256 (of the decoded bytes). Null texts are empty; an empty text has no tokens. The rank file is read on
    the driver and sent to the executors (about 1 MB). A text that does not decode to itself is an error and stops the
    job. Scan only: no shuffle.
    """
    with open(ranks_path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = codec(content.value)
        data, offsets = binary_parts(batch["text"])
        for lo, hi in chunks(offsets):
            piece, offs = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            ids, begin = own.encode(piece, offs)
            back = own.decode(ids)
            if len(back) != len(piece) or not (back == piece).all():
                raise ValueError("a text does not decode to itself")
            made = {
                "ids": lambda i, ids=ids, begin=begin: ids[begin[i] : begin[i + 1]].astype(np.int32),
                "starts": lambda i, ids=ids, begin=begin, piece=piece, offs=offs: token_starts(own, ids[begin[i] : begin[i + 1]], piece[offs[i] : offs[i + 1]]).astype(np.int32),
                "ids_sha256": lambda i, ids=ids, begin=begin: hashlib.sha256(ids[begin[i] : begin[i + 1]].astype("<u4").tobytes()).hexdigest(),
                "decoded_sha256": lambda i, back=back, offs=offs: hashlib.sha256(back[offs[i] : offs[i + 1]].tobytes()).hexdigest(),
            }
            kinds = {"array<int>": pa.list_(pa.int32()), "string": pa.string()}
            out = [pa.array([made[c](i) for i in range(hi - lo)], kinds[COLUMNS[c]]) for c in columns]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), pa.array(np.diff(begin), pa.int64()), *out], ["doc_id", "n_tokens", *columns])

    return map_arrow(docs.select("doc_id", "text"), run, ", ".join(["doc_id long", "n_tokens long", *(f"{c} {COLUMNS[c]}" for c in columns)]))


def bpe_decode(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """The bytes and text of ``tokens`` (doc_id, ids): doc_id, bytes, text. Null ids are empty; bytes that are not UTF-8,
    as when a character's last token is missing, show as U+FFFD in text and as they are in bytes."""
    with open(ranks_path, "rb") as f:
        content = tokens.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = codec(content.value)
        raw = [own.decode(np.array(x or [], dtype=np.int64)).tobytes() for x in batch["ids"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(raw, pa.binary()), pa.array([x.decode("utf-8", "replace") for x in raw], pa.string())], ["doc_id", "bytes", "text"])

    return map_arrow(tokens.select("doc_id", "ids"), run, "doc_id long, bytes binary, text string")
