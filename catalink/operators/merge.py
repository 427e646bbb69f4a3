"""Upsert where the first non-null value wins.

``INSERT ... ON CONFLICT (key) DO UPDATE SET c = COALESCE(old.c, new.c)``
as one full outer join on the key: existing non-null values are never
changed, new rows are added, and columns outside the update list (such as a
manual user id) keep their existing value.  Write the result with
``sinks.write_swap`` when it replaces the table it was read from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_first_non_null(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    coalesce_cols: Sequence[str],
    keep_cols: Sequence[str] = (),
) -> DataFrame:
    """Merge ``incoming`` into ``existing`` on ``key``.

    * key only in ``existing``: the row stays as it is;
    * key only in ``incoming``: inserted; ``keep_cols`` taken from incoming;
    * both: ``coalesce_cols`` = coalesce(existing, incoming); ``keep_cols``
      keep the existing value.

    ``incoming`` must be unique on ``key`` (one row per key, as a single
    upsert statement requires); both sides are hash-partitioned on the whole
    key, so the join cannot fan out.
    """
    key = list(key)
    old = existing.select(*key, *[F.col(c).alias(f"_old_{c}") for c in (*coalesce_cols, *keep_cols)], F.lit(True).alias("_in_old"))
    new = incoming.select(*key, *[F.col(c).alias(f"_new_{c}") for c in (*coalesce_cols, *keep_cols) if c in incoming.columns])
    joined = old.join(new, key, "full")
    cols = [F.col(k) for k in key]
    for c in coalesce_cols:
        cols.append(F.coalesce(F.col(f"_old_{c}"), F.col(f"_new_{c}")).alias(c))
    for c in keep_cols:
        fresh = F.col(f"_new_{c}") if c in incoming.columns else F.lit(None)
        cols.append(F.when(F.col("_in_old"), F.col(f"_old_{c}")).otherwise(fresh).cast(existing.schema[c].dataType).alias(c))
    return joined.select(*cols)
