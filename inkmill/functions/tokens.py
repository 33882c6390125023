"""Token counts by a public byte-pair vocabulary, in place of the approximate counter."""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: how text is cut into words before pairs are merged.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(4)
def encoding(path: str) -> object:
    """The encoding of a rank file (base64 of a token, a blank, its rank), read once in each process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def counter(path: str) -> Callable[[Column], Column]:
    """A function from a text column to its number of tokens; null and empty texts have 0. Runs in Arrow batches."""

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        held = encoding(path)
        return pd.Series([len(held.encode_ordinary(t)) if t else 0 for t in texts], dtype="int32")

    return lambda c: count(c)


def lengths(path: str) -> Callable[[list[str]], list[int]]:
    """The same for a list of texts, within a task."""
    return lambda texts: [len(encoding(path).encode_ordinary(t)) for t in texts]
