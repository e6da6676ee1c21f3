"""Ingestion modes as pure functions from (state, batch) to state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.dates import parse_timestamp, patterns_for
from tidegate.operators.shape import column
from tidegate.session import BROADCAST_LIMIT, broadcast_if_small, staged

# Configured mode -> what it does to the current table.
MODES = {
    "FULL_SNAPSHOT": "snapshot",
    "OVERWRITE": "snapshot",
    "DELTA_FROM_FLOW": "append",
    "DELTA_FROM_LOT": "append",
    "DELTA_FROM_HISTORIZED": "append",
    "APPEND": "append",
    "DELTA_FROM_NON_HISTORIZED": "merge",
    "MERGE": "merge",
    "FULL_KEY_REPLACE": "key_replace",
}
NEEDS_KEYS = ("merge", "key_replace")
PROCESS_DATE = "FILE_PROCESS_DATE"


def mode_action(name: str | None) -> tuple[str, bool]:
    """(action, known); an unknown mode appends."""
    found = MODES.get((name or "").strip().upper())
    return found or "append", found is not None


def no_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [column(k).isNotNull() for k in keys])


def comparable(df: DataFrame, name: str) -> Column:
    """Compare column as a value with an order; text is read as a timestamp."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.coalesce(parse_timestamp(column(name), patterns_for(None)), F.try_to_timestamp(column(name)))
    return column(name)


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the greatest order per key.

    An aggregation instead of a window: each task keeps one row per key before the shuffle, however
    often a key occurs.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    best = df.groupBy(*[column(k) for k in keys]).agg(
        F.max_by(F.struct(*[column(c) for c in rest]) if rest else F.lit(1), ranked).alias("_best"))
    return best.select([column(c) if c in keys else F.col("_best").getField(c).alias(c) for c in df.columns])


def merge_newest(target: DataFrame | None, batch: DataFrame, keys: Sequence[str], compare: str,
                 tie_break: Sequence[str] = (), batch_bytes: int | None = None,
                 broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Upsert: a strictly newer batch row replaces the target row of its key, unknown keys are added.

    Several batch rows of one key count as their newest. Rows with a null key part match nothing and are
    added as they are. With a batch of proven small size the target is neither shuffled nor sorted.
    """
    if not keys:
        raise ValueError("a merge needs at least one key")
    order = [comparable(batch, compare), *[column(c) for c in tie_break]]
    helper = [c for c in tie_break if c.startswith("_")]
    columns = [c for c in batch.columns if c not in helper]
    keyed = newest_per_key(batch.filter(no_null(keys)), keys, order).select([column(c) for c in columns])
    loose = batch.filter(~no_null(keys)).select([column(c) for c in columns])
    if target is None:
        return keyed.unionByName(loose)
    # Three branches read it.
    keyed = staged(keyed, "newest")

    shared = [c for c in target.columns if c in columns]
    small = batch_bytes is not None and batch_bytes <= broadcast_limit
    # Null keys would all hash to one task; they cannot match, so they take their own way.
    base = target if small else target.filter(no_null(keys))
    new = keyed.select(*[column(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                       comparable(keyed, compare).alias("_new"),
                       F.struct(*[column(c) for c in shared]).alias("_u"))
    old = base.select("*", comparable(base, compare).alias("_old"))
    on = reduce(lambda a, b: a & b, [column(k) == F.col(f"_k{i}") for i, k in enumerate(keys)])
    hit = F.col("_new") > F.col("_old")
    joined = old.join(broadcast_if_small(new, batch_bytes, broadcast_limit), on, "left_outer")
    kept = joined.select([
        F.when(hit, F.col("_u").getField(c)).otherwise(column(c)).alias(c)
        if c in shared and c not in keys else column(c) for c in target.columns])

    known = base.select([column(k) for k in keys])
    if small:
        # At most one row per batch key survives, so this side is bounded by the batch.
        incoming = F.broadcast(keyed.select([column(k) for k in keys]))
        known = F.broadcast(known.join(incoming, list(keys), "left_semi").distinct())
    else:
        # Combined before the shuffle: a key the target holds many times counts once.
        known = known.distinct()
    added = keyed.join(known, list(keys), "left_anti").unionByName(loose)
    state = kept.unionByName(conform(added, target))
    return state if small else state.unionByName(target.filter(~no_null(keys)))


def conform(df: DataFrame, target: DataFrame) -> DataFrame:
    """The columns of the target: absent ones NULL, others dropped, types aligned."""
    return df.select([
        (column(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in target.schema.fields])


def key_replace(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
                key_bytes: int | None = None) -> DataFrame:
    """Remove every target row whose whole key occurs in the batch, then add the batch."""
    if not keys:
        raise ValueError("replacing by key needs at least one key")
    if target is None:
        return batch
    incoming = batch.filter(no_null(keys)).select([column(k) for k in keys]).distinct()
    small = key_bytes is not None and key_bytes <= BROADCAST_LIMIT
    # Null keys match nothing. In a shuffled join they would all go to one task, so they take their own way.
    base = target if small else target.filter(no_null(keys))
    kept = base.join(broadcast_if_small(incoming, key_bytes), list(keys), "left_anti")
    kept = kept if small else kept.unionByName(target.filter(~no_null(keys)))
    return append(kept.select([column(c) for c in target.columns]), batch)


def append(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Add rows; columns on either side only are kept and filled with NULL."""
    return batch if target is None else target.unionByName(batch, allowMissingColumns=True)


def apply_mode(name: str | None, target: DataFrame | None, batch: DataFrame, keys: Sequence[str] = (),
               compare: str | None = None, tie_break: Sequence[str] = (),
               batch_bytes: int | None = None) -> DataFrame:
    """New current state for a configured mode name."""
    action, _ = mode_action(name)
    if action in NEEDS_KEYS and not keys:
        raise ValueError(f"{name} needs merge keys")
    if action == "merge":
        return merge_newest(target, batch, keys, compare or PROCESS_DATE, tie_break, batch_bytes)
    batch = batch.select([column(c) for c in batch.columns if not (c in tie_break and c.startswith("_"))])
    if action == "snapshot":
        return batch.select([column(c) for c in batch.columns if c != PROCESS_DATE])
    return key_replace(target, batch, keys, batch_bytes) if action == "key_replace" else append(target, batch)
