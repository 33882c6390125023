"""Problem 7: responses over a size limit cut into overlapping pieces at natural boundaries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.encoding import RANK_FILE, TOKENIZERS, encoder

LIMIT, OVERLAP = 3000, 200
#: Boundaries from the best kind to the weakest; a match ends where the next piece may begin.
KINDS = (("paragraph", re.compile(r"\n[^\S\n]*\n\s*")), ("line", re.compile(r"[\n\r  ]\s*")), ("sentence", re.compile(r"[.!?…][\"'”»’)\]*_]*\s+")), ("word", re.compile(r"\s+")))


def boundaries(text: str) -> list[np.ndarray]:
    """For each kind, the sorted offsets at which a new piece may begin."""
    return [np.array([m.end() for m in pattern.finditer(text)], np.int64) for _, pattern in KINDS]


def token_offsets(text: str, path: str | None = None) -> np.ndarray:
    """Tokens that begin before each character of a text, by a public tokenizer: prefix sums for ``cut``."""
    ids, _ = (e := encoder(path or f"{TOKENIZERS}/{RANK_FILE}")).encode_batch([text])
    sizes = e.sizes()[ids]
    begins = np.zeros(int(sizes.sum()) + 1, np.int64)
    begins[np.cumsum(sizes) - sizes] = 1
    counted = np.concatenate(([0], np.cumsum(begins)))
    ends = np.cumsum([0, *(len(c.encode("utf-8", "replace")) for c in text)])
    return counted[ends]


def cut(text: str, limit: int = LIMIT, overlap: int = OVERLAP, offsets: np.ndarray | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind of the cut at the end) of the pieces; each has at most ``limit`` characters.

    The end of a piece is the last boundary of the best kind that lies in the second half of what the limit allows
    (a weaker kind where the better has none there), else the last boundary of any kind in the piece, else the limit
    itself: a hard cut. The next piece begins at the first sentence, line or word boundary among the last ``overlap``
    characters, or exactly that far back; behind a piece not longer than the overlap it begins where that ended.
    ``offsets``, prefix sums with one entry more than characters, puts limit and overlap into other units, such as tokens
    (``token_offsets``); a single character over the limit is a piece.
    """
    upto = np.arange(len(text) + 1) if offsets is None else offsets
    if upto[-1] <= limit:
        return [(0, len(text), "end")]
    kinds = boundaries(text)
    places = np.unique(np.concatenate(kinds))
    out: list[tuple[int, int, str]] = []
    start = 0
    while upto[-1] - upto[start] > limit:
        furthest = max(start + 1, int(np.searchsorted(upto, upto[start] + limit, "right")) - 1)
        end, how = furthest, "hard"
        # a piece must outgrow its overlap, so that the next one begins later
        least = int(np.searchsorted(upto, upto[start] + max(overlap + 1, limit // 2), "left"))
        for (kind, _), at in zip(KINDS, kinds):
            i = int(np.searchsorted(at, furthest, "right")) - 1
            if i >= 0 and at[i] >= least:
                end, how = int(at[i]), kind
                break
        else:
            i = int(np.searchsorted(places, furthest, "right")) - 1
            if i >= 0 and places[i] > start:
                end, how = int(places[i]), "word"
        out.append((start, end, how))
        back = int(np.searchsorted(upto, upto[end] - overlap, "left"))
        if back <= start:
            start = end
            continue
        i = int(np.searchsorted(places, back, "left"))
        start = int(places[i]) if i < len(places) and places[i] < end else back
    if start < len(text):
        out.append((start, len(text), "end"))
    return out


def long_records(records: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per distinct id whose response is over the limit; the first ingested row of the id stands for it."""
    order = F.struct("ingested_at", F.xxhash64("response")) if "ingested_at" in records.columns else F.xxhash64("response")
    kept = records.where((F.length("response") > limit) & F.col("id").isNotNull()).select("id", "response", F.col("meta.char_span").alias("span"), order.alias("o"))
    return kept.groupBy("id").agg(F.min_by(F.struct("response", "span"), "o").alias("r")).select("id", "r.response", "r.span")


def split_oversized(records: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(id, piece, text, span_start, span_end, cut) of every record whose response exceeds ``limit`` characters.

    Spans count from the record's own span start, 0 where it has none or a null one. Shorter, empty and null responses
    and null ids give no rows. Surrogates that do not form a character count as one.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for i, text, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for k, (a, b, how) in enumerate(cut(text, limit, overlap)):
                    rows.append((i, k, text[a:b], base + a, base + b, how))
            if rows:
                columns = list(zip(*rows))
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "piece", "text", "span_start", "span_end", "cut"])

    base = F.coalesce(F.try_element_at("span", F.lit(1)), F.lit(0)).cast("bigint").alias("base")
    return long_records(records, limit).select("id", "response", base).mapInArrow(run, "id string, piece bigint, text string, span_start bigint, span_end bigint, cut string")


def cover(cut: DataFrame, records: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(id, covered, within_limit, texts_match): what the pieces of each record cover without gaps, whether each keeps to the
    limit, and whether each is what stands at its place in the record."""
    whole = long_records(records, limit).select("id", "response", F.coalesce(F.try_element_at("span", F.lit(1)), F.lit(0)).cast("bigint").alias("base"))
    placed = cut.join(whole, "id").withColumn("a", F.col("span_start") - F.col("base")).withColumn("b", F.col("span_end") - F.col("base"))
    ahead = F.expr("max(b) over (partition by id order by piece rows between unbounded preceding and 1 preceding)")
    # a piece adds what lies beyond those before it; one that begins beyond them leaves a gap
    placed = placed.withColumn("upto", F.coalesce(ahead, F.lit(0))).withColumn("adds", F.when(F.col("a") > F.col("upto"), F.lit(0)).otherwise(F.col("b") - F.col("upto")))
    same = F.col("text") == F.substring(F.col("response"), (F.col("a") + 1).cast("int"), (F.col("b") - F.col("a")).cast("int"))
    return placed.groupBy("id").agg(F.sum("adds").alias("covered"), F.min(F.length("text") <= limit).alias("within_limit"), F.min(same).alias("texts_match"))
