"""Problems 5 and 8: byte-pair encoding of whole texts with the ranks of a public tokenizer.

Within a word, the part boundaries and the ranks of adjacent pairs are kept in flat lists; the smallest rank is found
by a scan, its boundary deleted and the neighbouring ranks refreshed. Words longer than SCAN_BYTES keep the same
arrays but find the smallest rank through a heap, so that a long run costs n log n. Ids of words are remembered.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.wordstream import chunks, mix, powers

TOKENIZERS = os.environ.get("INKMILL_TOKENIZERS", "/opt/tokenizers")
RANK_FILE = "byte_bpe_50k.tiktoken"
#: The pattern published with the rank files (a fixed value); ``split_points`` states it on arrays.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SCAN_BYTES, REMEMBERED = 64, 200_000
_NONE = 1 << 60


_SPACE, _LETTER, _NUMBER, _OTHER, _BREAK = range(5)
#: White space of the pattern (a fixed value): the Unicode property, without the separators U+001C to U+001F.
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_tables: dict[str, np.ndarray] = {}


def _char_tables() -> tuple[np.ndarray, np.ndarray]:
    if not _tables:
        kinds = {"L": _LETTER, "N": _NUMBER}
        kind = np.full(0x110001, _OTHER, np.uint8)
        kind[:0x40000] = [kinds.get(unicodedata.category(chr(i))[0], _OTHER) for i in range(0x40000)]
        kind[_WHITE] = _SPACE
        kind[0x110000] = _BREAK
        _tables["code"] = mix(np.arange(1, 0x110002, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _tables["kind"] = kind
    return _tables["kind"], _tables["code"]


def split_points(chars: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where the pattern starts a new word, for texts ended by a _BREAK each, as a mask over the characters."""
    before = np.concatenate(([np.uint8(_BREAK)], kind[:-1]))
    blank = np.concatenate(([False], chars[:-1] == 32))
    word = (kind != _SPACE) & (kind != _BREAK)
    # a word takes one blank before it along; any other white space before it stands alone
    start = (kind != before) & ~(word & blank)
    # of a run of white space before a word, the last character parts from the rest
    ahead = np.concatenate((word[1:], [False]))
    start |= (kind == _SPACE) & ahead
    start |= kind == _BREAK
    marks = np.flatnonzero((chars == 39) & start)
    marks = marks[marks + 2 < len(chars)]
    if len(marks):
        one, two = chars[marks + 1], chars[marks + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("l")) & (two == ord("l"))) | (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")))
        start[marks[short | long] + 1] = False
        start[marks[short] + 2] = True
        start[marks[long] + 3] = True
    return start


class Encoder:
    """Token ids of texts. ``path`` is a rank file: base64 of a token, a blank and its rank on each line.

    Words are found by 64-bit hashes and held against the word that was kept; each different word is encoded once.
    """

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self._forget()

    def _forget(self) -> None:
        self.number: dict[int, int] = {}
        self.ids: list[tuple[int, ...]] = []
        self.words: list[str] = []

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and their offsets by text. A null text is an empty one."""
        if not texts:
            return np.empty(0, np.int32), np.zeros(1, np.int64)
        kinds, codes = _char_tables()
        texts = [t or "" for t in texts]
        joined = "\n".join([*texts, ""])
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts])
        kind = kinds[chars]
        kind[ends - 1] = _BREAK
        first = np.flatnonzero(split_points(chars, kind))
        up, down = powers(len(chars) + 1)
        total = np.zeros(len(chars) + 1, np.uint64)
        np.cumsum(codes[chars] * up[: len(chars)], out=total[1:])
        last = np.append(first[1:], len(chars))
        hashes = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))
        # the break of a text is a word that has no ids
        hashes[kind[first] == _BREAK] = 0
        different, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.ids) > REMEMBERED:
            self._forget()
        rows = []
        for h, i in zip(different.tolist(), at.tolist()):
            n, word = self.number.get(h), joined[first[i] : last[i]] if h else ""
            if n is None:
                n = self.number[h] = len(self.ids)
                self.words.append(word)
                self.ids.append(self.word(word.encode("utf-8", "replace")) if h else ())
            rows.append(self.ids[n] if self.words[n] == word else self.word(word.encode("utf-8", "replace")))
        sizes = np.array([len(r) for r in rows], np.int64)
        flat = np.fromiter(itertools.chain.from_iterable(rows), np.int32, int(sizes.sum()))
        begin = np.cumsum(sizes) - sizes
        size = sizes[which]
        ended = np.cumsum(size)
        source = np.repeat(begin[which] - (ended - size), size) + np.arange(int(size.sum()))
        offsets = np.zeros(len(texts) + 1, np.int64)
        offsets[1:] = ended[np.searchsorted(first, ends - 1)]
        return flat[source], offsets

    def sizes(self) -> np.ndarray:
        """Bytes of each token."""
        out = np.zeros(max(self.ranks.values()) + 1, np.int64)
        out[list(self.ranks.values())] = [len(t) for t in self.ranks]
        return out

    def word(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one word."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        return self._scan(piece) if len(piece) <= SCAN_BYTES else self._heap(piece)

    def _scan(self, piece: bytes) -> tuple[int, ...]:
        get = self.ranks.get
        bounds = list(range(len(piece) + 1))
        # adjacent[i]: rank of the two parts that begin at bounds[i], none for the last part
        adjacent = [get(piece[i : i + 2], _NONE) for i in range(len(piece) - 1)]
        while adjacent:
            least = min(adjacent)
            if least == _NONE:
                break
            i = adjacent.index(least)
            del bounds[i + 1], adjacent[i]
            if i < len(adjacent):
                adjacent[i] = get(piece[bounds[i] : bounds[i + 2]], _NONE)
            if i:
                adjacent[i - 1] = get(piece[bounds[i - 1] : bounds[i + 1]], _NONE)
        return tuple(self.ranks[piece[a:b]] for a, b in zip(bounds, bounds[1:]))

    def _heap(self, piece: bytes) -> tuple[int, ...]:
        get, n = self.ranks.get, len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n + 1))
        rank = [get(piece[i : i + 2], _NONE) for i in range(n - 1)] + [_NONE, _NONE]
        queue = [(r, i) for i, r in enumerate(rank) if r != _NONE]
        heapq.heapify(queue)

        def refresh(i: int) -> None:
            j = after[i]
            rank[i] = get(piece[i : after[j]], _NONE) if j < n else _NONE
            if rank[i] != _NONE:
                heapq.heappush(queue, (rank[i], i))

        while queue:
            r, i = heapq.heappop(queue)
            if rank[i] != r:
                continue
            gone = after[i]
            rank[gone] = -1
            after[i] = after[gone]
            before[after[gone]] = i
            refresh(i)
            if i:
                refresh(before[i])
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return tuple(ids)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a rank file, read once in each process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_documents(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row, without special tokens: their strings are ordinary text.

    Null and empty texts have the empty list; a lone surrogate is read as ?; repeated rows stay repeated.
    """
    path = path or f"{TOKENIZERS}/{RANK_FILE}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            column = batch.column(1).to_pylist()
            for a, b in chunks(column):
                ids, offsets = e.encode_batch(column[a:b])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def token_counts(texts: DataFrame, path: str | None = None) -> DataFrame:
    """(text_key, tokens) for rows (text_key, text); a null text has 0 tokens."""
    path = path or f"{TOKENIZERS}/{RANK_FILE}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            column = batch.column(1).to_pylist()
            for a, b in chunks(column):
                counts = np.diff(e.encode_batch(column[a:b])[1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts)], names=["text_key", "tokens"])

    return texts.select("text_key", "text").mapInArrow(run, f"text_key {texts.schema['text_key'].dataType.simpleString()}, tokens bigint")
