"""Keep held-out texts out of a training pool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladewerk.operators.joins import BROADCAST_BYTES, join_unique

def _digest(column: str) -> Column:
    return F.unhex(F.sha2(F.col(column).cast("binary"), 256))


def exclude_texts(
    pool: DataFrame, held_out: DataFrame, text: str = "text", broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int | None = None,
) -> DataFrame:
    """Rows of `pool` whose text is not among the held-out texts, exactly; copies
    of a held-out text under other ids go too, rows without a text stay.

    Few held-out texts (their digests take `broadcast_bytes` at most) are sent to every
    task. Of many, a bitmap lets most of the pool pass unshuffled, and a text that a large
    part of the pool shares is spread by its measured count.
    """
    # Distinct first: each task sends a repeated text once.
    digests = held_out.select(_digest(text).alias("_digest")).where("_digest IS NOT NULL").distinct()
    keyed = pool.withColumn("_digest", _digest(text))
    return join_unique(keyed, digests, ["_digest"], "left_anti", broadcast_bytes, hot_rows=hot_rows).drop("_digest")
