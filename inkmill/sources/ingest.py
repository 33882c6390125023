"""From raw rows of three shapes to records: A conversations, B standalone pieces, C long documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions.ids import record_id
from inkmill.functions.text import clean_text
from inkmill.schema import to_records
from inkmill.sources.index import first_of, with_row_index


def _speaks(turn: Column, parts: tuple[str, ...]) -> Column:
    role = F.lower(turn["from"])
    said = F.contains(role, F.lit(parts[0]))
    for p in parts[1:]:
        said = said | F.contains(role, F.lit(p))
    return F.coalesce(said, F.lit(False))


def last_pair(conversation: Column) -> Column:
    """The last adjacent turns user, assistant of a conversation as a struct (prompt, response), or null.

    Roles are matched by parts of their lower-case names. A pair with an empty side is null; no earlier one is taken.
    """
    turns = F.coalesce(conversation, F.array().cast("array<struct<from:string,value:string>>"))
    places = F.when(F.size(turns) >= 2, F.sequence(F.lit(2), F.size(turns))).otherwise(F.array().cast("array<int>"))
    hits = F.filter(places, lambda i: _speaks(F.get(turns, i - 1), ("assistant", "gpt")) & _speaks(F.get(turns, i - 2), ("human", "user")))
    at = F.try_element_at(hits, F.lit(-1))
    prompt, response = F.get(turns, at - 2)["value"], F.get(turns, at - 1)["value"]
    return F.when((F.length(prompt) > 0) & (F.length(response) > 0), F.struct(prompt.alias("prompt"), response.alias("response")))


def _source_id(df: DataFrame, id_column: str | None, order: list[str]) -> DataFrame:
    """Add source_id: the id column where it has a value, else item_ and the row's position in the source.

    Only if ids are missing are positions worked out, over the order columns alone; they are joined to the rows without
    an id, so texts are neither sorted nor written. Of rows alike in the order columns the smaller hash comes first.
    """
    own = F.when(F.col(id_column).cast("string") != "", F.col(id_column).cast("string")) if id_column and id_column in df.columns else F.lit(None).cast("string")
    known = df.withColumn("source_id", own).where("source_id is not null")
    missing = df.where(own.isNull())
    if missing.isEmpty():
        return known
    narrow = df.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], own.isNull().alias("_missing"))
    keys = [f"_o{i}" for i in range(len(order))]
    placed = with_row_index(narrow, keys).where("_missing").withColumn("_tie", F.row_number().over(Window.partitionBy(*keys).orderBy("row_index")))
    rows = missing.withColumn("_tie", F.row_number().over(Window.partitionBy(*order).orderBy(F.xxhash64(*[c for c, t in df.dtypes if "map<" not in t]))))
    same = placed["_tie"] == rows["_tie"]
    for k, c in zip(keys, order):
        same = same & placed[k].eqNullSafe(rows[c])
    found = rows.join(placed, same).select(*[rows[c] for c in df.columns], F.concat(F.lit("item_"), placed["row_index"].cast("string")).alias("source_id"))
    return known.unionByName(found)


def first_of_id(df: DataFrame, order: list[str]) -> DataFrame:
    """One row for each source id, the first in order: a row delivered again does not count twice."""
    return first_of(df, F.col("source_id"), order)


def ingest_conversations(df: DataFrame, name: str, *, column: str = "conversations", id_column: str = "id", order: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Shape A. One record for each conversation with a usable last pair; texts stay as they are."""
    rows = first_of_id(_source_id(df, id_column, order), order).withColumn("pair", last_pair(F.col(column))).where("pair is not null")
    out = rows.select(
        record_id(F.lit(name), F.col("source_id")).alias("id"), F.lit(name).alias("source_dataset_name"), "pair.prompt", "pair.response", F.lit("human").alias("prompt_type"), F.col("source_id").alias("original_id"), *keep
    )
    return to_records(out, keep=keep)


def ingest_texts(df: DataFrame, name: str, *, text_column: str = "text", id_column: str | None = None, order: list[str], path_column: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Shapes B and C. One record for each text that is not empty once cleaned; without a prompt."""
    # the cleaned text goes through an array of one, so it is worked out once for the filter and the projection
    cleaned = F.explode(F.filter(F.array(clean_text(F.col(text_column).cast("string"))), lambda t: t != ""))
    rows = _source_id(df, id_column, order).select("*", cleaned.alias("_text"))
    out = rows.select(
        record_id(F.lit(name), F.col("source_id"), F.col("_text")).alias("id"),
        F.lit(name).alias("source_dataset_name"),
        F.lit(None).alias("prompt"),
        F.col("_text").alias("response"),
        F.lit(None).alias("prompt_type"),
        F.col("source_id").alias("original_id"),
        (F.col(path_column) if path_column else F.lit(None)).cast("string").alias("source_path"),
        *keep,
    )
    return to_records(out, source_path=True, keep=keep)


def ingest_files(df: DataFrame, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Shape C from a folder of text files: the file's name is the source id, its path the source path."""
    return ingest_texts(df, name, id_column="file_name", order=["file_name"], path_column="source_path", keep=keep)


def union_records(*parts: DataFrame) -> DataFrame:
    """All records of several datasets; fields missing from one are null there."""
    if not parts:
        raise ValueError("no datasets")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
