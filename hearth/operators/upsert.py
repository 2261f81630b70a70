"""Key-matched upsert of a batch into a table (as a new table version).

``update`` form: every incoming row replaces the stored row with the same key
(all non-key columns take the incoming value, nulls included); new keys are
inserted. ``do-nothing`` form (a table with no non-key columns): only new
keys are added. The result is a new frame; the caller writes it as a new
version and never overwrites what it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_upsert(existing: DataFrame, incoming: DataFrame, keys=("listing_id",)) -> DataFrame:
    """Existing rows without an incoming match, plus every incoming row.

    Keys are compared null-safe. Incoming keys must be unique (checked by R7
    before a write). Spark joins by the sizes it knows: a small batch is
    broadcast under its own byte limit (or by AQE at run time), so that the
    stored table is only scanned; otherwise both sides shuffle on the key.
    """
    keys = list(keys)
    cols = existing.columns
    incoming = incoming.select(*cols)
    non_key = [c for c in cols if c not in keys]
    inc_keys = incoming.select(*[F.col(k).alias(f"__in_{k}") for k in keys])
    if not non_key:
        # INSERT .. ON CONFLICT DO NOTHING: keep stored rows, add new keys.
        ex_keys = existing.select(*[F.col(k).alias(f"__ex_{k}") for k in keys])
        new = incoming.join(ex_keys, [incoming[k].eqNullSafe(ex_keys[f"__ex_{k}"]) for k in keys], "left_anti")
        return existing.unionByName(new)
    kept = existing.join(inc_keys, [existing[k].eqNullSafe(inc_keys[f"__in_{k}"]) for k in keys], "left_anti")
    return kept.unionByName(incoming)
