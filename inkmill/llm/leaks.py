"""Problem 9: documents that hold passages of evaluation items.

All runs of 12 words of the items form one Aho-Corasick automaton over the normalised text (lower-cased words with one
blank between them); every document is scanned once. Positions are mapped back to the original through the places of
its words, which are worked out for the documents with a match only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.shared import materialize

WORDS = 12
#: Items and characters that go into one automaton; a larger evaluation set is scanned for in several passes.
ITEMS_A_PASS, CHARS_A_PASS = 20_000, 20_000_000
_WORD = re.compile(r"[^\W_]+")


def normalise(text: str) -> str:
    """The words of a text in lower case, a blank around each."""
    return f" {' '.join(_WORD.findall(text))} ".lower()


def automaton(items: list[tuple[int, str]], n: int = WORDS) -> ahocorasick.Automaton:
    """Patterns are all runs of n words; the value of a pattern is the list of items that hold it."""
    found: dict[str, set[int]] = {}
    for item, text in items:
        w = normalise(text or "").split()
        for i in range(len(w) - n + 1):
            found.setdefault(f" {' '.join(w[i : i + n])} ", set()).add(item)
    a = ahocorasick.Automaton()
    for pattern, holders in found.items():
        a.add_word(pattern, sorted(holders))
    a.make_automaton()
    return a


def matches(a: ahocorasick.Automaton, text: str, n: int = WORDS) -> list[tuple[int, int, int, int]]:
    """(item, first character, end, words) of each maximal stretch that a text shares with an item."""
    flat = normalise(text)
    runs: dict[int, list[list[int]]] = {}
    at = passed = 0
    for end, holders in a.iter(flat):
        # matches come in order, so the blanks are counted once
        passed += flat.count(" ", at, end)
        at, last = end, passed - 1
        for item in holders:
            stretches = runs.setdefault(item, [])
            if stretches and stretches[-1][1] == last - 1:
                stretches[-1][1] = last
            else:
                stretches.append([last - n + 1, last])
    if not runs:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    return [(item, places[i][0], places[j][1], j - i + 1) for item, stretches in runs.items() for i, j in stretches]


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The distinct items in blocks of a bounded size, in order of their ids; one block is in the driver at a time."""
    items = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("bigint"), "text").distinct().orderBy("item_id", "text")
    block: list[tuple[int, str]] = []
    chars = 0
    for row in items.toLocalIterator():
        block.append((row[0], row[1]))
        chars += len(row[1])
        if len(block) >= ITEMS_A_PASS or chars >= CHARS_A_PASS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def leaked_passages(documents: DataFrame, items: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, item_id, start_pos, end_pos, n_words): every passage of at least ``words`` words that a document shares
    with an item, as long as it goes, at its place in the original text.

    Null texts and ids have no rows; a document given twice has one row a passage; with no items there are no rows.
    A stretch may join passages that follow one another in both texts but for their order within the item.

    Items go in blocks of ITEMS_A_PASS items or CHARS_A_PASS characters (an item longer than that is a block of its own).
    With more than one block, the passages of each are written to the shared folder before the next block is sent, so
    driver and executors hold one block at a time; each block reads the documents once.
    """
    schema = "doc_id bigint, item_id bigint, start_pos bigint, end_pos bigint, n_words bigint"
    spark, out = documents.sparkSession, None
    docs = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint"), "text")
    blocks = _blocks(items)
    block = next(blocks, None)
    while block is not None:
        sent = spark.sparkContext.broadcast(block)
        block = next(blocks, None)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            a = automaton(sent.value, words)
            if not len(a):
                return
            for batch in batches:
                rows = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for m in matches(a, t, words)]
                if rows:
                    frame = pd.DataFrame(rows, columns=["doc_id", "item_id", "start_pos", "end_pos", "n_words"]).astype("int64")
                    yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

        part = docs.mapInArrow(run, schema)
        if block is not None or out is not None:  # done with this block before the next one is sent
            part = materialize(part, "passages")
            sent.destroy()
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out.distinct()


def leak_report(documents: DataFrame, items: DataFrame, words: int = WORDS) -> DataFrame:
    """(item_id, task, documents, longest): how many documents hold a passage of each item, 0 included."""
    found = leaked_passages(documents, items, words).groupBy("item_id").agg(F.count_distinct("doc_id").alias("documents"), F.max("n_words").alias("longest"))
    every = items.where("item_id is not null").groupBy(F.col("item_id").cast("bigint").alias("item_id")).agg(F.min("task").alias("task"))
    return every.join(found, "item_id", "left").select("item_id", "task", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("longest", F.lit(0)).alias("longest"))
