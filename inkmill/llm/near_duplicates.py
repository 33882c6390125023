"""Problem 1: records whose response is mostly the same text.

Every distinct response becomes a bag of word sequences, its BagMinHash registers a fingerprint of eight bits each. The
fingerprint and a permutation of it are cut into code blocks; texts that share a block and whose fingerprints lie
within a Hamming radius are verified on the sets of word sequences. Copies of one text travel once and are expanded by
membership at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm import bagminhash, wordstream
from inkmill.llm.components import components
from inkmill.llm.shared import join_sizes, materialize, small
from inkmill.llm.wordstream import chunks

#: A block of more texts than this is joined in salted parts of about this size.
HOT_BUCKET = 2_000
#: Most texts whose 64-bit hash is shared with a different text; about 300 are to be expected among 10**11 texts.
MAX_CLASHES = 10_000
#: The fingerprint: registers of eight bits, and registers in a code block. 200 registers cut twice make 80 blocks.
REGISTERS, ROWS, TURNS = 200, 5, 2
#: Bits of 1,600 in which the fingerprints of a pair may differ. 400 are to be expected at a similarity of a half, with a
#: standard deviation of 32; unrelated texts differ in about 750.
RADIUS = 528


def keyed(records: DataFrame, hashed: Column | None = None) -> DataFrame:
    """(id, text_key, text) of the records that have an id and a response.

    The key is a 64-bit hash. Texts of one key are held against each other by a second hash; the keys for which that
    differs (hardly ever any) are given anew from both hashes. ``hashed`` is another first hash, for tests.
    """
    key, second = F.xxhash64("response") if hashed is None else hashed, F.xxhash64(F.lit("second"), "response")
    rows = records.where(F.col("id").isNotNull() & F.col("response").isNotNull()).select("id", key.alias("text_key"), F.col("response").alias("text"), second.alias("_c"))
    mixed = rows.groupBy("text_key").agg(F.min("_c").alias("a"), F.max("_c").alias("b")).where("a <> b").select("text_key").limit(MAX_CLASHES + 1).collect()
    if len(mixed) > MAX_CLASHES:
        raise ValueError(f"more than {MAX_CLASHES} hashes stand for several texts each")
    if mixed:
        rows = rows.withColumn("text_key", F.when(F.col("text_key").isin(*[r["text_key"] for r in mixed]), F.xxhash64("_c", "text_key")).otherwise(F.col("text_key")))
    return rows.select("id", "text_key", "text")


def fingerprints(texts: DataFrame, *, words: int, min_words: int, weighted: bool, registers: int = REGISTERS) -> DataFrame:
    """(text_key, code) of each distinct text of ``texts`` (text_key bigint, text string) with enough words.

    ``weighted`` takes the multiplicities of the sequences into account, damped: a sequence held n times weighs
    1 + log2(n) / 4, as the pairs are defined on sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, column = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for a, b in chunks(column):
                hashes, offsets = wordstream.words(column[a:b])
                element, bag, count = wordstream.bags(*wordstream.shingles(hashes, offsets, words))
                enough = np.diff(offsets) >= min_words
                keep = enough[bag]
                rank = np.cumsum(enough) - 1
                element, bag, count = element[keep], rank[bag[keep]], count[keep]
                n = int(enough.sum())
                if not n:
                    continue
                times = bagminhash.signatures(element, bag, 1 + np.log2(count) / 4 if weighted else np.ones(len(element)), n, registers)
                code = bagminhash.longs(bagminhash.code(times))
                at = np.arange(0, (n + 1) * code.shape[1], code.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(keys[a:b][enough]), pa.ListArray.from_arrays(pa.array(at), pa.array(code.ravel()))], names=["text_key", "code"])

    found = texts.select("text_key", "text").mapInArrow(run, "text_key bigint, code array<bigint>")
    return found.groupBy("text_key").agg(F.first("code").alias("code"))


def sequence_sets(texts: DataFrame, words: int) -> DataFrame:
    """(text_key, n_words, seqs): the distinct word sequences of each text as 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, column = batch.column(0), batch.column(1).to_pylist()
            for a, b in chunks(column):
                hashes, offsets = wordstream.words(column[a:b])
                seq, owner = wordstream.shingles(hashes, offsets, words)
                order = np.lexsort((seq, owner))
                seq, owner = seq[order], owner[order]
                if len(seq):
                    new = np.concatenate(([True], (seq[1:] != seq[:-1]) | (owner[1:] != owner[:-1])))
                    seq, owner = seq[new], owner[new]
                at = np.searchsorted(owner, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(a, b - a), pa.array(np.diff(offsets).astype(np.int64)), pa.ListArray.from_arrays(pa.array(at), pa.array(seq.view(np.int64)))],
                    names=["text_key", "n_words", "seqs"],
                )

    return texts.select("text_key", "text").mapInArrow(run, "text_key bigint, n_words bigint, seqs array<bigint>")


def block_rows(prints: DataFrame, rows: int = ROWS, turns: int = TURNS) -> DataFrame:
    """(text_key, side, block): the code blocks of each fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            codes = batch.column(2).flatten().to_numpy().reshape(n, -1).view(np.uint8)
            block = bagminhash.segments(codes, rows, turns)
            repeated = [np.repeat(batch.column(k).to_numpy(), block.shape[1]) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, repeated), pa.array(block.ravel())], names=["text_key", "side", "block"])

    return prints.select("text_key", "side", "code").mapInArrow(run, "text_key bigint, side int, block bigint")


def hamming(a: Column, b: Column, longs: int) -> Column:
    """Bits in which two fingerprints differ."""
    return reduce(lambda x, y: x + y, [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(longs)])


def candidate_pairs(prints: DataFrame, radius: int = RADIUS, registers: int = REGISTERS) -> DataFrame:
    """Pairs (a, b), a < b, of text keys that share a code block and whose fingerprints lie within ``radius`` bits.

    ``prints`` is a written table (text_key, code, side). side is 1 or 2, or 3 for a text on both sides; one text of a
    pair must be of side 1 and the other of side 2.

    Blocks are counted by partial aggregates that also bring the least and greatest text, so a block of two texts is a
    pair already and a block of one goes no further. Only the rows of larger blocks move again; of these a block
    with more than HOT_BUCKET texts is cut into salted parts before it is joined. No task sees a whole hot block.
    """
    rows = block_rows(prints)
    met = materialize(rows.groupBy("block").agg(F.count("*").alias("n"), F.min("text_key").alias("a"), F.max("text_key").alias("b"), F.bit_or("side").alias("side")).where("n > 1 and side = 3"), "blocks")
    more = met.where("n > 2").select("block", "n")
    held = materialize(join_sizes(rows, small(more, 500_000), "block", hot=HOT_BUCKET), "held")
    parts = F.ceil(F.col("n") / HOT_BUCKET).cast("int")
    left = held.select("block", F.col("text_key").alias("a"), F.col("side").alias("sa"), F.pmod("text_key", parts).cast("int").alias("salt"))
    right = held.select("block", F.col("text_key").alias("b"), F.col("side").alias("sb"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"))
    across = F.col("sa").bitwiseOR(F.col("sb")) == 3
    joined = left.join(right, ["block", "salt"]).where((F.col("a") < F.col("b")) & across).select("a", "b")
    pairs = met.where("n = 2").select("a", "b").union(joined).distinct()
    codes = [prints.select(F.col("text_key").alias(k), F.col("code").alias(f"c{k}"), F.col("side").alias(f"s{k}")) for k in "ab"]
    near = hamming(F.col("ca"), F.col("cb"), registers // 8) <= radius
    return pairs.join(codes[0], "a").join(codes[1], "b").where(near & across).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """The pairs whose sets of word sequences overlap by at least ``similarity`` (intersection over union)."""
    sets = sets.where(F.col("n_words") >= min_words)
    a = sets.select(F.col("text_key").alias("a"), F.col("seqs").alias("sa"))
    b = sets.select(F.col("text_key").alias("b"), F.col("seqs").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    joined = pairs.join(a, "a").join(b, "b").withColumn("both", both)
    return joined.where(F.col("both") >= similarity * (F.size("sa") + F.size("sb") - F.col("both"))).select("a", "b")


def similar_texts(rows: DataFrame, *, similarity: float, sequence: int, min_words: int, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact check of candidate pairs among ``rows`` (see ``keyed``).

    Returns the verified pairs of text keys, each text that has copies also with itself, and the membership
    (text_key, id) of all records.
    """
    members = rows.select("text_key", "id").distinct()
    copied = members.groupBy("text_key").count().where("count > 1").select("text_key")
    pairs = materialize(pairs, "pairs")
    wanted = materialize(pairs.select(F.col("a").alias("text_key")).union(pairs.select("b")).union(copied).distinct(), "wanted")
    texts = rows.join(small(wanted, 500_000), "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
    sets = materialize(sequence_sets(texts, sequence), "sets")
    near = verified(pairs, sets, min_words, similarity)
    same = sets.where(F.col("n_words") >= min_words).join(copied, "text_key", "left_semi").select(F.col("text_key").alias("a"), F.col("text_key").alias("b"))
    return materialize(near.union(same), "links"), members


def near_duplicate_links(records: DataFrame, *, similarity: float = 0.5, sequence: int = 3, min_words: int = 60, radius: int = RADIUS, hashed: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Verified links between response texts, the membership of the records (see ``similar_texts``), and the keyed rows."""
    rows = keyed(records, hashed)
    prints = materialize(fingerprints(rows, words=sequence, min_words=min_words, weighted=True).withColumn("side", F.lit(3)), "prints")
    return *similar_texts(rows, similarity=similarity, sequence=sequence, min_words=min_words, pairs=candidate_pairs(prints, radius)), rows


def expand(links: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of record ids, id_a < id_b, of linked texts and of copies of one text."""
    a = members.select(F.col("text_key").alias("a"), F.col("id").alias("x"))
    b = members.select(F.col("text_key").alias("b"), F.col("id").alias("y"))
    pairs = links.join(a, "a").join(b, "b").where("x <> y")
    return pairs.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def near_duplicate_pairs(records: DataFrame, **parameters: object) -> DataFrame:
    """Pairs (id_a, id_b) of records with near-duplicate responses.

    Null ids and null responses take no part; responses under ``min_words`` words (empty ones too) have no pairs;
    repeated rows count once; an empty table gives no rows; other columns are ignored.
    """
    links, members, _ = near_duplicate_links(records, **parameters)
    return expand(links, members)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pairs, records): how many records have so many near-duplicates."""
    ends = pairs.select(F.col("id_a").alias("id")).unionAll(pairs.select("id_b"))
    return ends.groupBy("id").agg(F.count("*").alias("pairs")).groupBy("pairs").agg(F.count("*").alias("records"))


def small_sets(texts: DataFrame, words: int, most: int) -> DataFrame:
    """(text_key, n_words, seqs) as in ``sequence_sets``, of texts with 1 to ``most`` distinct sequences.

    A text with fewer words than a sequence has one sequence of all its words; one without words has none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, column = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for a, b in chunks(column):
                hashes, offsets = wordstream.words(column[a:b])
                n_words = np.diff(offsets)
                parts = [wordstream.shingles(hashes, offsets, words)]
                for k in range(1, words):
                    seq, owner = wordstream.shingles(hashes, offsets, k)
                    whole = n_words[owner] == k
                    parts.append((seq[whole], owner[whole]))
                seq, owner = (np.concatenate(x) for x in zip(*parts))
                order = np.lexsort((seq, owner))
                seq, owner = seq[order], owner[order]
                if len(seq):
                    new = np.concatenate(([True], (seq[1:] != seq[:-1]) | (owner[1:] != owner[:-1])))
                    seq, owner = seq[new], owner[new]
                size = np.bincount(owner, minlength=b - a)
                kept = (size > 0) & (size <= most)
                if not kept.any():
                    continue
                at = np.concatenate(([0], np.cumsum(size[kept]))).astype(np.int32)
                seq = seq[kept[owner]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[a:b][kept]), pa.array(n_words[kept].astype(np.int64)), pa.ListArray.from_arrays(pa.array(at), pa.array(seq.view(np.int64)))],
                    names=["text_key", "n_words", "seqs"],
                )

    found = texts.select("text_key", "text").mapInArrow(run, "text_key bigint, n_words bigint, seqs array<bigint>")
    return found.groupBy("text_key").agg(F.first("n_words").alias("n_words"), F.first("seqs").alias("seqs"))


def short_links(texts: DataFrame, *, similarity: float, sequence: int, below: int) -> DataFrame:
    """(a, b), a < b: text keys whose sets of sequences overlap by ``similarity``, at least one with under ``below`` words.

    Banding would lose pairs of so few sequences, so this is an exact join. The sequences of every text are put in one
    order, rarest first; texts that overlap enough then share a sequence among the first ones of both, at places that
    leave room for the overlap. A longer text takes part while it has so few distinct sequences that it can overlap a
    short one.
    """
    sets = materialize(small_sets(texts, sequence, int(max(1, below - sequence) / similarity)), "short")
    share = similarity / (1 + similarity)
    least = lambda x: F.ceil(x - F.lit(1e-9))
    rows = sets.select("text_key", (F.col("n_words") < below).alias("short"), F.size("seqs").alias("size"), F.explode("seqs").alias("seq"))
    met = materialize(rows.groupBy("seq").agg(F.count("*").alias("n"), F.max("short").alias("s")).where("n > 1 and s").select("seq", "n"), "met")
    # a sequence that no other text has, or long ones alone, counts as held once
    rows = join_sizes(rows, met, "seq", hot=HOT_BUCKET, how="left").withColumn("n", F.coalesce("n", F.lit(1)))
    rows = rows.withColumn("place", F.expr("row_number() over (partition by text_key order by n, seq)"))
    first = materialize(rows.where((F.col("n") > 1) & (F.col("place") <= F.col("size") - least(F.col("size") * similarity) + 1)), "first")

    def pairs(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        # the smaller set stands on the left, where fewer places are enough
        left = left.where(F.col("place") <= F.col("size") - least(F.col("size") * 2 * share) + 1).select(*on, F.col("text_key").alias("a"), F.col("short").alias("sa"), F.col("size").alias("na"), F.col("place").alias("pa"))
        right = right.select(*on, F.col("text_key").alias("b"), F.col("short").alias("sb"), F.col("size").alias("nb"), F.col("place").alias("pb"))
        room = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) + 1 >= least((F.col("na") + F.col("nb")) * share)
        ordered = F.expr("na < nb or (na = nb and a < b)") & (F.col("na") >= F.col("nb") * similarity)
        return left.join(right, on).where(ordered & (F.col("sa") | F.col("sb")) & room).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    parts = F.ceil(F.col("n") / HOT_BUCKET).cast("int")
    salted = first.withColumn("salt", F.pmod(F.col("text_key"), parts).cast("int"))
    spread = first.withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    found = materialize(pairs(salted, spread, ["seq", "salt"]).distinct(), "short-pairs")
    return verified(found, sets, 1, similarity)


def near_duplicate_groups(records: DataFrame, *, similarity: float = 0.5, sequence: int = 3, min_words: int = 60, **parameters: object) -> DataFrame:
    """One row per distinct record id: (id, group_id, links).

    group_id is the smallest text key that the record's text is linked to, directly or through others; links counts
    the other texts it is directly linked to. Texts of any length are linked: ``min_words`` only decides which pairs are
    found by signature and which, with a shorter text, by ``short_links``. Texts with fewer words than a sequence are
    linked when their words are equal, texts without words when they are equal themselves. Records without links form
    groups of their own text; a record without a response has a null group.
    """
    links, _, rows = near_duplicate_links(records, similarity=similarity, sequence=sequence, min_words=min_words, **parameters)
    edges = materialize(links.where("a <> b").union(short_links(rows, similarity=similarity, sequence=sequence, below=min_words)), "edges")
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy("a").agg(F.count("*").alias("links"))
    label = components(edges.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    # an id that is given several texts takes the smallest key
    keys = rows.groupBy("id").agg(F.min("text_key").alias("text_key"))
    out = records.where("id is not null").select("id").distinct().join(keys, "id", "left")
    out = out.join(label.select(F.col("node").alias("text_key"), "component"), "text_key", "left").join(degree.withColumnRenamed("a", "text_key"), "text_key", "left")
    return out.select("id", F.coalesce("component", "text_key").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
