"""Merkle manifest of a table: one tree a group, and one tree over the groups' roots.

Leaves are numbered per group without gaps: the rows are range-partitioned and
sorted, and a partition's numbers begin where the counts of those before it end,
so a group that holds most rows is spread over many tasks.  At every level nodes
are equijoined with the nodes at their siblings' numbers (the number XOR 1 where
two make a run, one join for each other slot otherwise), and the rows of slot
zero emit the parents.  A level has half the rows of the one before, so all of
them together cost no more than two passes over the digests.

The siblings' digests then go down again, each level joined to its parents,
which gives every leaf its path to the root.  Texts are read once, for the leaf
digests; they are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import written
from sluice.operators.sizing import broadcast_if_small

FANOUT = 2
#: Levels that one plan joins before it is written.
_STEPS = 6


def field(value: Column) -> Column:
    """A value's part of its leaf: ``-`` if null, else its number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(parts: Column) -> Column:
    return F.unhex(F.sha2(parts, 256))


def as_hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (with ``grp``) with ``idx``, gapless from 0 in each group by ``order``, and ``cnt``, the group's size.

    Rows that are equal in ``order`` are dealt by where they were read, so that they do not meet in one task.
    """
    own = leaves.withColumn("_read", F.monotonically_increasing_id())
    by = ["grp", *order, "_read"]
    laid = own.repartitionByRange(*by).sortWithinPartitions(*by).drop("_read")
    laid = written(laid.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "merkle-leaves")
    # A row for each partition and group in it: as many as there are partitions and groups.
    counts = laid.groupBy("_part", "grp").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("grp")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", "grp", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("cnt"))
    joined = laid.join(broadcast_if_small(written(counts, "merkle-counts")), ["_part", "grp"])
    return joined.withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_at", "_first", "_before")


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Nodes (grp, idx, cnt, digest) with ``before`` and ``after``: the digests of their run's other nodes, in order."""
    slot = F.col("idx") % fanout
    found = nodes
    for k in range(1, fanout):
        other = F.col("idx").bitwiseXOR(F.lit(1)) if fanout == 2 else F.col("idx") - slot + (slot + k) % fanout
        there = nodes.select(F.col("grp").alias("_grp"), F.col("idx").alias("_idx"), F.col("digest").alias(f"_s{k}"))
        found = found.withColumn("_other", other).join(
            there, (F.col("grp") == F.col("_grp")) & (F.col("_other") == F.col("_idx")), "left").drop("_grp", "_idx", "_other")
    none = F.lit(b"")

    def at(place: int) -> Column:
        """The digest in another slot than the node's own; none where the last run has no such node."""
        return reduce(lambda rest, k: F.when((slot + k) % fanout == place, F.coalesce(F.col(f"_s{k}"), none)).otherwise(rest), range(1, fanout), none)

    before = F.concat(*[F.when(slot > p, at(p)).otherwise(none) for p in range(fanout)])
    after = F.concat(*[F.when(slot < p, at(p)).otherwise(none) for p in range(fanout)])
    return found.select("grp", "idx", "cnt", "digest", before.alias("before"), after.alias("after"))


def levels_of(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame | None]:
    """All levels (grp, idx, cnt, digest, before, after) of groups with more than one node, from the leaves up, and the
    roots (grp, digest, height) of all groups, or None without nodes."""
    levels, roots = [], []
    most = nodes.agg(F.max("cnt")).first()[0]
    while most is not None:
        roots.append(nodes.where("cnt = 1").select("grp", "digest", F.lit(len(levels)).alias("height")))
        if most <= 1:
            break
        level = written(with_siblings(nodes.where("cnt > 1"), fanout), "merkle-level")
        levels.append(level)
        nodes = level.where(F.col("idx") % fanout == 0).select(
            "grp", F.floor(F.col("idx") / fanout).alias("idx"), F.ceil(F.col("cnt") / fanout).alias("cnt"),
            digest(as_hex(F.concat("digest", "after"))).alias("digest"))
        most = -(-most // fanout)
    return levels, reduce(DataFrame.unionByName, roots) if roots else None


def paths_down(levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """From the groups' roots (grp, height, path, and other columns) down to the leaves: (grp, idx, path, …), where a
    path has (before, after) of every level, from the leaf's up."""
    carried = [c for c in tops.columns if c not in ("grp", "height", "path")]

    def of(height: int) -> DataFrame:
        return tops.where(F.col("height") == height).select("grp", F.lit(0).cast("long").alias("idx"), "path", *carried)

    above = of(len(levels))
    for k, level in reversed(list(enumerate(levels))):
        up = above.select(F.col("grp").alias("_grp"), F.col("idx").alias("_idx"), F.col("path").alias("_path"), *carried)
        own = level.select("grp", "idx", F.struct("before", "after").alias("_step"), F.floor(F.col("idx") / fanout).alias("_up"))
        below = own.join(up, (F.col("grp") == F.col("_grp")) & (F.col("_up") == F.col("_idx")))
        above = below.select("grp", "idx", F.concat(F.array("_step"), F.col("_path")).alias("path"), *carried).unionByName(of(k))
        if k and k % _STEPS == 0:
            above = written(above, "merkle-paths")
    return above


def manifest(df: DataFrame, fields: list[str], order: str = "doc_id", group: str = "lang", fanout: int = FANOUT,
             tampered: dict[str, Callable[[Column], Column]] | None = None, where: Column | None = None) -> DataFrame:
    """Every row of ``df`` once: ``order``, ``leaf``, ``subroot``, ``root``, ``path`` (array of ``before`` and ``after``,
    the digests of the run's other nodes, from the leaf up), ``idx`` and ``folded_root``.

    A leaf is the SHA-256 of the row's ``fields``, each as ``field`` writes it.  A group's leaves ascend by ``order``
    (nulls first, ties by digest); as long as there are several nodes, each ``fanout`` consecutive ones become the
    SHA-256 of their digests as hex text.  The last is the group's subroot, and the subroots, in the groups' bytewise
    order (null first), become the root in the same way.  ``folded_root`` is worked out from the row's path and its
    leaf, where the rows that ``where`` picks have their fields changed by ``tampered``.

    Repeated rows are leaves of their own.  Null and empty texts differ.  Other columns are not read.  An empty table
    gives no rows.  Digests are lower-case hex, but for those in ``path``, which are binary.
    """
    values = [F.col(f"`{c}`") for c in fields]
    changed = [(tampered or {}).get(c, lambda v: v)(v) for c, v in zip(fields, values)]
    leaf = digest(F.concat(*[field(v) for v in values]))
    other = F.when(F.coalesce(where, F.lit(False)), digest(F.concat(*[field(v) for v in changed]))) if where is not None else F.lit(None).cast("binary")
    # Null groups come first: their key is empty, and that of others begins with a mark.
    grp = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    leaves = df.select(grp.alias("grp"), F.col(f"`{order}`").alias("key"), leaf.alias("digest"), other.alias("changed"))
    leaves = written(numbered(leaves, ["key", "digest"]), "merkle-numbered")

    levels, subroots = levels_of(leaves.select("grp", "idx", "cnt", "digest"), fanout)
    kind = df.schema[order].dataType.simpleString()
    if subroots is None:
        return df.sparkSession.createDataFrame([], f"`{order}` {kind}, leaf string, subroot string, root string, "
                                               "path array<struct<before:binary,after:binary>>, idx long, folded_root string")
    subroots = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("own"), "digest", "height")
    tops = written(numbered(subroots, ["own"]), "merkle-subroots")
    upper, roots = levels_of(tops.select("grp", "idx", "cnt", "digest"), fanout)
    empty = F.array().cast("array<struct<before:binary,after:binary>>")
    first = roots.select("grp", "height", empty.alias("path"), F.col("digest").alias("root"))
    down = paths_down(upper, first, fanout).drop("grp").join(tops.select("idx", "own", "height", "digest"), "idx")
    down = written(down.select(F.col("own").alias("grp"), "height", "path", F.col("digest").alias("subroot"), "root"), "merkle-upper")
    paths = paths_down(levels, down, fanout)
    joined = leaves.join(paths.hint("merge"), ["grp", "idx"])

    # Each step puts the node between the run's others.
    folded = F.aggregate("path", F.coalesce("changed", "digest"), lambda node, step: F.unhex(F.sha2(as_hex(F.concat(step["before"], node, step["after"])), 256)))
    return joined.select(F.col("key").alias(order), as_hex(F.col("digest")).alias("leaf"), as_hex(F.col("subroot")).alias("subroot"),
                         as_hex(F.col("root")).alias("root"), "path", "idx", as_hex(folded).alias("folded_root"))


def proof(path: Column) -> Column:
    """SHA-256 of all siblings of a path, as hex text, from the leaf up and left to right."""
    return F.sha2(as_hex(F.aggregate(path, F.lit(b""), lambda found, step: F.concat(found, step["before"], step["after"]))), 256)
