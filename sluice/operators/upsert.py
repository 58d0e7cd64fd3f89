"""Keyed upserts without MERGE (parquet tables have none).

* ``latest_per_key`` keeps the last row per key (the reference applies a batch
  in order with ``executemany``, so the last row for a key wins).  It is a
  ``groupBy(key).max_by(row, order)`` aggregate, not a window: the partial
  aggregate runs map-side, so a key holding a third of the batch is reduced
  to one row per task before the shuffle.
* ``merge_replace`` (``INSERT … ON DUPLICATE KEY UPDATE`` of every column):
  ``target ▷ delta.keys ∪ delta``.  When the delta is proven small its keys
  are broadcast and the target is never shuffled; otherwise a sort-merge
  anti join.
* ``merge_columns`` updates only the listed columns on a key match and fills
  insert-time defaults for new keys, keeping a hit flag so that a NULL in
  the delta still overwrites.
* ``spelled_as_stored`` lets keys match under a collation: it brings the
  delta's keys to the spelling of the stored ones before any of the merges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluice.operators.sizing import is_small

_HIT = "__hit"
_ROW = "__row"


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per key by ``order`` (ties broken by the whole row, deterministic)."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    row = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*[F.col(c) for c in order], row)
    return (df.groupBy(*keys).agg(F.max_by(row, rank).alias(_ROW))
            .select(*keys, *[F.col(f"{_ROW}.{c}").alias(c) for c in rest]))


def spelled_as_stored(delta: DataFrame, keys: list[str], order: list[str], stored: DataFrame | None,
                      collation: str) -> DataFrame:
    """Last row per key, where keys are equal that ``collation`` takes for equal, under one spelling of the key: that
    of the ``stored`` rows where they have it, else the first by ``order``, as a source database keeps the key of the
    row it inserted and updates the rest.  What follows may then compare keys byte by byte.

    One partial aggregate reduces a hot key; the stored keys are joined to a delta that has each key once.  NULL keys
    match nothing.
    """
    strings = {f.name for f in delta.schema.fields if isinstance(f.dataType, StringType)}
    same = {f"__same_{k}": F.collate(F.col(k), collation) if k in strings else F.col(k) for k in keys}
    row, own = F.struct(*[F.col(c) for c in delta.columns]), F.struct(*[F.col(k) for k in keys])
    rank = F.struct(*[F.col(c) for c in order], row)
    latest = delta.withColumns(same).groupBy(*same).agg(F.max_by(row, rank).alias(_ROW), F.min_by(own, rank).alias("__own"))
    spelling = F.col("__own")
    if stored is not None:
        # Only stored keys that the delta has; several of one key (stored without this collation) count as the least.
        latest = materialize(latest)
        held = stored.select(*keys).withColumns(same).join(_maybe_broadcast_keys(latest.select(*same), None), list(same), "left_semi")
        held = held.groupBy(*same).agg(F.min(own).alias("__stored"))
        latest = latest.join(held, list(same), "left")
        spelling = F.coalesce("__stored", "__own")
    return latest.select(*[(spelling[c] if c in keys else F.col(f"{_ROW}.{c}")).alias(c) for c in delta.columns])


_CHEAP_PLANS = ("LocalRelation", "LogicalRelation", "LogicalRDD", "Range")


def materialize(df: DataFrame) -> DataFrame:
    """Compute a delta that a merge reads several times exactly once.

    A local relation or a plain file scan is cheap to read again; anything
    else (joins, aggregates) gets a reliable checkpoint in the shared folder.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    node = plan
    while node.getClass().getSimpleName() in ("Project", "Filter") and node.children().size() == 1:
        node = node.children().apply(0)
    if node.getClass().getSimpleName() in _CHEAP_PLANS:
        return df
    return df.checkpoint(eager=True)


def _maybe_broadcast_keys(df: DataFrame, small: bool | None) -> DataFrame:
    if small is None:
        small = is_small(df)
    return F.broadcast(df) if small else df


def merge_replace(target: DataFrame, delta: DataFrame, keys: list[str],
                  delta_small: bool | None = None) -> DataFrame:
    """Replace whole rows by key; new keys are inserted.  ``delta`` must be unique per key."""
    cols = target.columns
    delta = materialize(delta.select(*cols))
    kept = target.join(_maybe_broadcast_keys(delta.select(*keys), delta_small), keys, "left_anti")
    return kept.unionByName(delta)


def merge_replace_ordered(target: DataFrame, delta: DataFrame, keys: list[str], order: str,
                          delta_small: bool | None = None) -> DataFrame:
    """Whole-row upsert where a delta row wins only if its ``order`` value is
    not older than the stored row's.  Applying the same delta twice, or
    deltas in any order, gives the same table (replay-safe for streams).
    ``delta`` must be unique per key."""
    d = materialize(delta.select(*target.columns))
    dk = d.select(*keys, F.col(order).alias("__d_order"))
    small = is_small(dk) if delta_small is None else delta_small
    newer = (target.select(*keys, order)
             .join(F.broadcast(dk) if small else dk, keys)
             # NULL is the oldest order value, as in latest_per_key.
             .where((F.col(order) > F.col("__d_order"))
                    | (F.col("__d_order").isNull() & F.col(order).isNotNull())).select(*keys))
    win = d.join(F.broadcast(newer) if small else newer, keys, "left_anti")
    wk = win.select(*keys)
    kept = target.join(F.broadcast(wk) if small else wk, keys, "left_anti")
    return kept.unionByName(win)


def merge_columns(target: DataFrame, delta: DataFrame, keys: list[str], update_cols: list[str],
                  defaults: dict[str, Column] | None = None,
                  delta_small: bool | None = None) -> DataFrame:
    """On key match set ``update_cols`` from the delta and keep the rest.

    New keys take the delta's values for the columns it carries and
    ``defaults`` (else NULL) for the others.  ``delta`` must be unique per key.
    """
    defaults = defaults or {}
    cols = target.columns
    # Both the rows and the keys of the target are read.
    target = materialize(target)
    tschema = {f.name: f.dataType for f in target.schema.fields}
    d = materialize(delta.select(*keys, *[c for c in delta.columns if c not in keys])).withColumn(_HIT, F.lit(True))
    d_cols = [c for c in delta.columns if c not in keys]
    small = is_small(d) if delta_small is None else delta_small
    dr = d.select(*[F.col(c).alias(f"__d_{c}") for c in d.columns])
    cond = [F.col(k) == F.col(f"__d_{k}") for k in keys]
    on = cond[0]
    for c in cond[1:]:
        on = on & c

    def pick(c: str) -> Column:
        if c in update_cols:
            return F.when(F.col(f"__d_{_HIT}"), F.col(f"__d_{c}")).otherwise(F.col(c)).cast(tschema[c]).alias(c)
        return F.col(c)

    if small:
        # Target streams past a broadcast delta: no shuffle of the target.
        updated = target.join(F.broadcast(dr), on, "left").select(*[pick(c) for c in cols])
        matched = target.select(*keys).join(F.broadcast(d.select(*keys)), keys, "left_semi")
        new = d.join(F.broadcast(matched), keys, "left_anti")
    else:
        updated = target.join(dr, on, "left").select(*[pick(c) for c in cols])
        new = d.join(target.select(*keys), keys, "left_anti")

    def fill(c: str) -> Column:
        if c in keys or c in d_cols:
            return F.col(c).cast(tschema[c]).alias(c)
        return (defaults[c] if c in defaults else F.lit(None)).cast(tschema[c]).alias(c)

    return updated.unionByName(new.select(*[fill(c) for c in cols]))
