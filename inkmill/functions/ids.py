"""Record ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_id(name: Column, source_id: Column, content: Column | None = None, segment: Column | None = None) -> Column:
    """``sha256:`` and the hash of the name with the source id, or with a hash of the content where there is none.

    An empty source id counts as none. A segment number, where not null, is hashed along. A row with neither source id
    nor content gets null: an id made at random would change with every run.
    """
    own = F.when(source_id != "", F.concat_ws(":", name, source_id))
    if content is not None:
        own = F.coalesce(own, F.when(content != "", F.concat_ws(":", name, F.lit("contenthash"), F.substring(F.sha2(content, 256), 1, 16))))
    if segment is not None:
        own = F.when(segment.isNotNull(), F.concat(own, F.lit(":seg:"), segment.cast("string"))).otherwise(own)
    return F.concat(F.lit("sha256:"), F.sha2(own, 256))


def unit_hash(c: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of a value's SHA-256."""
    return F.conv(F.substring(F.sha2(c, 256), 1, 8), 16, 10).cast("bigint").cast("double") / F.lit(4294967296.0)
