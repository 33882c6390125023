"""Problem 2: splits in which all records of one work, or of works tied by authors, stay together."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.components import components
from inkmill.llm.shared import materialize

#: Shelf codes, fixed values of the data.
SHELVES = ("kt", "mv", "qo", "zr", "bx", "wy")
PROPORTIONS = {"train": 0.90, "validation": 0.05, "test": 0.05}
#: Seeds of which the one that meets the proportions best is taken, and buckets in which their scores are counted.
SEEDS, BUCKETS = 16, 4096


def work_of(c: Column) -> Column:
    """The clean work id (shelf code, -, eight digits) that a value names, or null.

    The code may stand in either case, after a prefix ending in a non-letter, before - _ : a blank or nothing, and the
    number may be padded or not.
    """
    pattern = r"(?i)(?<![a-z0-9])(" + "|".join(SHELVES) + r")[-_: ]?0*(\d{1,8})(?![0-9a-f]*[a-f])"
    code = F.lower(F.regexp_extract(c, pattern, 1))
    number = F.regexp_extract(c, pattern, 2)
    return F.when(code != "", F.concat(code, F.lit("-"), F.lpad(number, 8, "0")))


def author_of(c: Column) -> Column:
    """What identifies an author in any spelling of the handle: the number at its end. Null where there is none, as in
    the placeholders that name nobody."""
    number = F.regexp_extract(c, r"(\d+)\s*$", 1)
    return F.when(number != "", F.regexp_replace(number, "^0+(?=.)", ""))


def work_groups(work_authors: DataFrame, works: DataFrame) -> DataFrame:
    """(work, group_key): the smallest work of each set of works tied by shared authors.

    Rows without a work or an author relate nothing; ``works`` (column work) adds works that have no row.
    """
    rows = work_authors.select(work_of(F.col("work_id")).alias("work"), author_of(F.col("author")).alias("author"))
    named = rows.where("work is not null").select("work").union(works.select("work")).where("work is not null")
    # works sort before authors: every work starts with a lower-case letter, every author with ~
    edges = rows.where("work is not null and author is not null").distinct().select(F.col("work").alias("src"), F.concat(F.lit("~"), "author").alias("dst"))
    label = components(edges.union(named.distinct().select(F.col("work").alias("src"), F.col("work").alias("dst"))))
    return label.where(~F.col("node").startswith("~")).select(F.col("node").alias("work"), F.col("component").alias("group_key"))


def _record_works(records: DataFrame) -> DataFrame:
    """(id, work) with one row per distinct id; work is null where no row of the id names one."""
    return records.where("id is not null").select("id", work_of(F.col("meta.original_id")).alias("work")).groupBy("id").agg(F.min("work").alias("work"))


def grouped_records(records: DataFrame, work_authors: DataFrame) -> DataFrame:
    """(id, group_key) of the records that name a work; repeated rows count once."""
    works = materialize(_record_works(records).where("work is not null"), "works")
    return works.join(work_groups(work_authors, works.select("work")), "work").select("id", "group_key")


def related_records(records: DataFrame, work_authors: DataFrame) -> DataFrame:
    """(id, group_key) of the records whose group has two or more distinct ids.

    Null ids and ids naming no work are left out, as are null or placeholder authors; empty tables give no rows.
    """
    rows = materialize(grouped_records(records, work_authors), "grouped")
    return rows.join(rows.groupBy("group_key").count().where("count > 1").select("group_key"), "group_key").select("id", "group_key")


def _unit(key: Column, salt: str) -> Column:
    """A number in (0, 1) by hash."""
    return (F.pmod(F.xxhash64(F.lit(salt), key), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def score(key: Column, name: str, salt: str) -> Column:
    """-ln(u) of a split for a component; the split with the least score / weight wins the rendezvous."""
    return -F.log(_unit(key, f"{salt}:{name}"))


def against_rest(key: Column, name: str, salt: str) -> Column:
    """The rendezvous of one split with all that come after it: a number in (0, 1), evenly spread.

    With weights w and v, the split wins where score / w < rest / v, which is where this number is below w / (w + v).
    """
    own = score(key, name, salt)
    return own / (own + score(key, "rest", f"{salt}:{name}"))


def fitted(counted: list[tuple[int, int, int]], wanted: float) -> tuple[int, int]:
    """(seed, bucket): below which bucket of which seed the records come nearest to ``wanted``; of equals the first seed.

    ``counted`` has (seed, bucket, records).
    """
    best = (math.inf, 0, 0)
    by_seed: dict[int, dict[int, int]] = {}
    for seed, bucket, n in counted:
        by_seed.setdefault(seed, {})[bucket] = n
    for seed in sorted(by_seed):
        held, cuts = 0, [(0, 0)]
        for bucket in sorted(by_seed[seed]):
            held += by_seed[seed][bucket]
            cuts.append((bucket + 1, held))
        for cut, n in cuts:
            if abs(n - wanted) < best[0]:
                best = (abs(n - wanted), seed, cut)
    return best[1], best[2]


def assign_splits(records: DataFrame, work_authors: DataFrame, proportions: dict[str, float] | None = None, seed: str = "inkmill") -> DataFrame:
    """(id, group_key, split) for every distinct non-null id.

    A record that names no work forms a group of its own. Components of every size are placed by the same rule, weighted
    rendezvous hashing, split by split: in the order of their proportions each split meets all that come after it.
    Its weight is fitted so that the records (not the components) come out in the proportions: scores are counted in
    BUCKETS for each of SEEDS seeds, and the seed and weight that come nearest are taken. What is left is at most a
    bucket's records, unless a single component is larger than a split. The result does not depend on row order.
    """
    shares = {k: v for k, v in sorted((proportions or PROPORTIONS).items(), key=lambda x: (-x[1], x[0])) if v > 0}
    named = grouped_records(records, work_authors)
    ids = records.where("id is not null").select("id").distinct()
    rows = materialize(ids.join(named, "id", "left").select("id", F.coalesce("group_key", F.concat(F.lit("id:"), "id")).alias("group_key")), "components")
    sizes = materialize(rows.groupBy("group_key").agg(F.count("*").alias("n")), "sizes")
    names, left, split = list(shares), sum(shares.values()), F.lit(None).cast("string")
    for name in names[:-1]:
        free = sizes.where(split.isNull())
        buckets = F.array(*[F.floor(against_rest(F.col("group_key"), name, f"{seed}:{k}") * BUCKETS).cast("int") for k in range(SEEDS)])
        counted = free.select("n", F.posexplode(buckets).alias("seed", "bucket")).groupBy("seed", "bucket").agg(F.sum("n").alias("n")).collect()
        total = sum(r["n"] for r in counted if r["seed"] == 0)
        k, cut = fitted([(r["seed"], r["bucket"], r["n"]) for r in counted], total * shares[name] / left)
        won = F.floor(against_rest(F.col("group_key"), name, f"{seed}:{k}") * BUCKETS) < cut
        split = F.coalesce(split, F.when(won, F.lit(name)))
        left -= shares[name]
    return rows.select("id", "group_key", F.coalesce(split, F.lit(names[-1])).alias("split"))


def split_sizes(placed: DataFrame) -> DataFrame:
    """(group_key, records, splits) of the groups of two or more records: how many splits each lies in, which must be one."""
    sized = placed.groupBy("group_key").agg(F.count("*").alias("records"), F.min("split").alias("a"), F.max("split").alias("b"))
    return sized.where("records > 1").select("group_key", "records", F.when(F.col("a") == F.col("b"), 1).otherwise(2).alias("splits"))
