"""Long texts packed into chunks of whole sentences, with overlap and spans."""

from __future__ import annotations

import itertools
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions.ids import record_id
from inkmill.functions.text import pieces, strip, token_count
from inkmill.schema import META


def pack(tokens: list[int], most: int, overlap: int) -> list[tuple[int, int]]:
    """(first, last) sentence of each chunk.

    A chunk ends before the sentence that would take it over ``most``; a sentence over the limit stands alone. The
    last ``overlap`` sentences of a chunk that has more than that many open the next one, which then takes its next
    sentence whatever the size.
    """
    out: list[tuple[int, int]] = []
    first, total = 0, 0
    for i, n in enumerate(tokens):
        if i > first and total + n > most:
            out.append((first, i - 1))
            first = i - overlap if 0 < overlap < i - first else i
            total = sum(tokens[first:i])
        total += n
    if tokens:
        out.append((first, len(tokens) - 1))
    return out


def place(tokens: list[int], lengths: list[int], leads: list[int], bodies: list[int], most: int, overlap: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, spans of its sentences) of each chunk over the pieces that are not blank; offsets count from the text's
    start."""
    real, at = [], 0
    for n, length, lead, body in zip(tokens, lengths, leads, bodies):
        if body > 0:
            real.append((int(n), at + int(lead), at + int(lead) + int(body)))
        at += int(length)
    return [(real[a][1], real[b][2], [(s, e) for _, s, e in real[a : b + 1]]) for a, b in pack([n for n, _, _ in real], most, overlap)]


def sentences(df: DataFrame, key: str, text: str = "response") -> DataFrame:
    """(key, n, sentence, tokens): the sentences of each text that are not blank, numbered from 0 over all pieces."""
    parts = df.select(key, F.posexplode(pieces(F.col(text))).alias("n", "piece"))
    body = parts.select(key, "n", strip(F.col("piece")).alias("sentence")).where("sentence <> ''")
    return body.withColumn("tokens", token_count(F.col("sentence")))


def with_chunks(df: DataFrame, text: str, most: int, overlap: int, wanted: Column | None = None, counter: Callable[[list[str]], list[int]] | None = None) -> DataFrame:
    """Add _c, array<struct<start, end, text>>: the chunks of a text, each with its sentences joined by a blank.

    Rows that are not ``wanted`` get an empty array. Pieces are found and their tokens counted once, in a projection of
    their own; Python packs the numbers and cuts each chunk out of the text, so a text of any length is held once.
    ``counter`` counts the tokens of sentences there, in place of the approximate count.
    """

    @F.pandas_udf("array<struct<start:int,end:int,text:string>>")
    def packed(texts: pd.Series, tokens: pd.Series, lengths: pd.Series, leads: pd.Series, bodies: pd.Series) -> pd.Series:
        out = []
        for t, *arrays in zip(texts, tokens, lengths, leads, bodies):
            if counter is not None:
                begins = [0, *itertools.accumulate(map(int, arrays[1]))]
                arrays[0] = counter([t[b + int(lead) : b + int(lead) + int(n)] for b, lead, n in zip(begins, arrays[2], arrays[3])])
            out.append([(start, end, " ".join(t[s:e] for s, e in spans)) for start, end, spans in place(*arrays, most, overlap)])
        return pd.Series(out, dtype=object)

    source = F.col(text) if wanted is None else F.when(wanted, F.col(text))
    cut = df.withColumn("_raw", pieces(source)).withColumn("_bare", F.transform("_raw", strip))
    # what is stripped starts with the first character that is no white space, so its first place is its own
    leads = F.zip_with("_raw", "_bare", lambda p, b: F.greatest(F.instr(p, b) - 1, F.lit(0)))
    return cut.withColumn("_c", packed(source, F.transform("_bare", token_count), F.transform("_raw", F.length), leads, F.transform("_bare", F.length))).drop("_raw", "_bare")


def segment(
    df: DataFrame, most: int = 3800, overlap: int = 1, *, always: Column | None = None, count: Callable[[Column], Column] = token_count, counter: Callable[[list[str]], list[int]] | None = None
) -> DataFrame:
    """Records whose response exceeds 1.1 x ``most`` tokens become one record a chunk; others pass unchanged.

    A chunk has its sentences joined by a blank, the span of its first to last sentence in the response, an id made
    from the original id and its number, no prompt, labels or scores. ``always`` marks rows to cut whatever their
    length. A response without sentences gives no chunk. ``count`` (a column) and ``counter`` (a list of sentences) are
    another tokenizer's counts.
    """
    long = count(F.col("response")) > F.lit(most * 1.1)
    if always is not None:
        long = long | F.coalesce(always, F.lit(False))
    # the fields of meta go as columns: what follows a Python function must not reach into a struct
    fields = {f.name: f"_m_{f.name}" for f in META.fields}
    labels = {"top": "_top", "sub": "_sub"}
    flat = df.select(
        "id", "source_dataset_name", "prompt", "response", "scores", *[F.col(f"meta.{k}").alias(v) for k, v in fields.items()], *[F.col(f"classification.{k}").alias(v) for k, v in labels.items()], F.coalesce(long, F.lit(False)).alias("_long")
    )
    # one pass over all records: a record that is not cut gives one row without a chunk, a cut one its chunks alone
    cut = with_chunks(flat, "response", most, overlap, F.col("_long"), counter).withColumn("response", F.when(~F.col("_long"), F.col("response")))
    rows = cut.select("*", F.posexplode_outer("_c").alias("_k", "_p")).drop("_c").where("not _long or _k is not null")
    chunk_id = record_id(F.col("source_dataset_name"), F.coalesce("_m_original_id", "id"), None, F.col("_k"))
    span = F.array(F.col("_p.start"), F.col("_p.end"))
    keep = lambda new, old: F.when(F.col("_long"), new).otherwise(old)
    return rows.select(
        keep(chunk_id, F.col("id")).alias("id"),
        "source_dataset_name",
        F.when(~F.col("_long"), F.col("prompt")).alias("prompt"),
        keep(F.col("_p.text"), F.col("response")).alias("response"),
        F.struct(*[(keep(span, F.col(v)) if k == "char_span" else F.col(v)).alias(k) for k, v in fields.items()]).alias("meta"),
        F.struct(*[F.when(~F.col("_long"), F.col(v)).alias(k) for k, v in labels.items()]).alias("classification"),
        keep(F.create_map().cast("map<string,double>"), F.coalesce("scores", F.create_map().cast("map<string,double>"))).alias("scores"),
    )
