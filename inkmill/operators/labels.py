"""Genre labels: parsing, counting and sampling to quotas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.sources.index import checkpointed, sent

# The genres offered to the classifier unless the configuration names its own.
DEFAULT_GENRES = (
    "story_literary", "story_adventure", "story_fantasy", "story_science_fiction", "story_horror", "story_thriller", "story_mystery", "story_crime", "story_romance", "story_historical", "story_humor",
    "story_young_adult", "story_children", "story_fan_fiction", "story_other", "vignette", "song_lyrics", "poetry", "stage_play_script", "screenplay", "comic_script", "videogame_script", "memoir", "biography",
    "humor_nonfiction", "academic_article", "academic_book", "dissertation_thesis", "conference_paper", "literature_review", "research_proposal", "textbook_chapter", "news_report", "investigative_journalism",
    "how_to_guide", "popular_science", "reference_entry", "medical_info", "case_study", "technical_manual", "editorial", "column", "feature_article", "profile_interview", "business_report", "marketing_copy",
    "political_speech", "advocacy_paper", "grant_proposal", "faq_document", "legal_document", "product_description", "website_copy", "newsletter", "blog_post", "diary_entry", "social_media_post", "forum_post",
    "youtube_script", "review", "interactive_fiction", "rpg_scenario", "rpg_transcript", "travel_writing", "nature_writing", "food_writing", "personal_essay", "opinion_piece", "erotic_fiction", "erotic_roleplay", "other",
)
UNKNOWN = "unknown"
#: Hash buckets of a class when a quota is drawn (three hexadecimal digits), and how often the one at the edge is cut again.
BUCKETS, LEVELS = 4096, 2


def parse_genre(reply: Column, genres: Sequence[str] = DEFAULT_GENRES) -> Column:
    """The first genre of the list (then ``unknown``) that occurs in the lower-cased reply, else ``unknown``.

    The order of the list decides where one genre's name contains another's. Null replies are unknown.
    """
    low = F.lower(reply)
    hits = [F.when(F.contains(low, F.lit(g.lower())), g) for g in [*(genres or DEFAULT_GENRES), UNKNOWN]]
    return F.coalesce(*hits, F.lit(UNKNOWN))


def label_of(top: Column | str = "classification.top") -> Column:
    """The label, ``unknown`` where it is null."""
    return F.coalesce(F.col(top) if isinstance(top, str) else top, F.lit(UNKNOWN))


def class_counts(df: DataFrame, top: str = "classification.top") -> DataFrame:
    return df.groupBy(label_of(top).alias("top")).agg(F.count("*").alias("records"))


def quota_of(label: Column, quotas: Mapping[str, int], default: int) -> Column:
    """The quota of a label."""
    if not quotas:
        return F.lit(default)
    known = F.create_map(*[F.lit(x) for k, q in quotas.items() for x in (k, int(q))])
    return F.coalesce(F.try_element_at(known, label), F.lit(default))


def sample_quota(df: DataFrame, quotas: Mapping[str, int], default: int = 5000, *, seed: str = "0", top: str = "classification.top") -> DataFrame:
    """At most the quota of each label, drawn by hash without replacement; smaller classes whole, quota 0 none.

    The draw takes the rows of smallest hash of seed and id, so it doesn't depend on their order. A class is cut into
    BUCKETS by the head of the hash; buckets below the edge are taken whole after a count, the bucket at the edge is cut
    again by what follows, and only what is left at the last edge is ranked, a part in BUCKETS ** LEVELS of the class. Rows
    with a null id never pass.
    """
    rows = df.where("id is not null").withColumn("_label", label_of(top)).withColumn("_h", F.sha2(F.concat(F.lit(seed), F.col("id")), 256))
    parts, rest, quota = [], rows, None
    for level in range(LEVELS):
        # three hexadecimal digits a level
        rest = rest.withColumn("_b", F.conv(F.substring("_h", 1 + 3 * level, 3), 16, 10).cast("int"))
        sizes = rest.groupBy("_label", "_b").agg(F.count("*").alias("_n"))
        wanted = quota_of(F.col("_label"), quotas, default) if quota is None else F.col("_quota")
        sizes = (sizes if quota is None else sizes.join(sent(quota), "_label")).withColumn("_quota", wanted.cast("bigint"))
        upto = sizes.withColumn("_upto", F.expr("sum(_n) over (partition by _label order by _b rows between unbounded preceding and current row)"))
        over = F.when(F.col("_upto") > F.col("_quota"), F.struct(F.col("_b").alias("edge"), (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("room")))
        edge = checkpointed(upto.groupBy("_label").agg(F.min(over).alias("_e")).select("_label", F.coalesce("_e.edge", F.lit(BUCKETS)).alias("_edge"), F.coalesce("_e.room", F.lit(0).cast("bigint")).alias("_quota")))
        # one row a label: sent to all tasks while there are few labels, joined by shuffle beyond
        placed = rest.join(sent(edge.select("_label", "_edge")), "_label")
        parts.append(placed.where("_b < _edge").select(*df.columns))
        rest, quota = placed.where("_b = _edge").drop("_edge", "_b"), edge.where("_quota > 0").select("_label", "_quota")
    last = rest.join(sent(quota), "_label").withColumn("_r", F.expr("row_number() over (partition by _label order by _h, id)")).where("_r <= _quota")
    return reduce(DataFrame.unionByName, [*parts, last.select(*df.columns)])


def shuffled(df: DataFrame, seed: str = "1") -> DataFrame:
    """Rows in an order by hash, for a sink that keeps it."""
    return df.orderBy(F.sha2(F.concat(F.lit(seed), F.col("id")), 256), "id")
