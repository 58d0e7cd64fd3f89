"""Job-dependency lineage: resolved edges, pending jobs, execution levels, closure and cycles.

The reference hands its dependency graph to a scheduler; here the graph is
data.  Levels are computed by frontier expansion (Kahn's algorithm in
batches): each round is a few joins over the jobs and edges that are left, which
are checkpointed to the shared folder to cut lineage; the number of rounds is the
graph's depth, and a cycle is reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_edges(edges: DataFrame, known: DataFrame) -> DataFrame:
    """Keep edges whose dependency names a defined job (others are ignored)."""
    return edges.join(known.select(F.col("job").alias("dep")), "dep", "left_semi").select("job", "dep")


def pending_jobs(defined: DataFrame, completed: DataFrame) -> DataFrame:
    """Defined minus completed (completion rows are keyed by job for one mode)."""
    return defined.select("job").join(completed.select("job"), "job", "left_anti")


def dependency_levels(jobs: DataFrame, edges: DataFrame) -> DataFrame:
    """Level 0 = no dependency; otherwise 1 + the highest level among dependencies.

    ``jobs``: (job); ``edges``: (job, dep) already resolved.  Every round that
    assigns a job shrinks what is left, so the rounds end by themselves; jobs
    left by a round that assigns none are on, or behind, a cycle and get a NULL
    level.  A round reads only the jobs and edges that are left.
    """
    left = jobs.select("job").distinct().checkpoint(eager=True)
    open_edges = edges.select("job", "dep").distinct().checkpoint(eager=True)
    levels: DataFrame | None = None
    level = 0
    while True:
        ready = left.join(open_edges.select("job"), "job", "left_anti").select(
            "job", F.lit(level).alias("level")).checkpoint(eager=True)
        if ready.isEmpty():
            break
        levels = ready if levels is None else levels.unionByName(ready)
        if level % 16 == 15:
            levels = levels.checkpoint(eager=True)
        left = left.join(ready, "job", "left_anti").checkpoint(eager=True)
        open_edges = open_edges.join(ready.select(F.col("job").alias("dep")), "dep", "left_anti") \
            .select("job", "dep").checkpoint(eager=True)
        level += 1
    rest = left.select("job", F.lit(None).cast("int").alias("level"))
    return rest if levels is None else levels.unionByName(rest)


def dependency_closure(edges: DataFrame) -> DataFrame:
    """(job, ancestor) of everything a job needs, directly or not, each pair once; a job on a cycle is its own ancestor.

    By path doubling: a round joins the pairs found last with all pairs on both ends, so paths of twice the length
    are known after it and the rounds are the logarithm of the depth.  Only pairs that are new go on; each round is
    checkpointed.  Rows with a NULL end are no edges.
    """
    new = edges.where(F.col("job").isNotNull() & F.col("dep").isNotNull()).select("job", F.col("dep").alias("ancestor")).distinct().checkpoint(eager=True)
    found = new
    while not new.isEmpty():
        def then(first: DataFrame, second: DataFrame) -> DataFrame:
            onward = second.select(F.col("job").alias("via"), F.col("ancestor").alias("further"))
            return first.join(onward, F.col("ancestor") == F.col("via")).select("job", F.col("further").alias("ancestor"))

        # Paths of up to twice the length end or begin with one that was found last.
        longer = then(new, found).unionByName(then(found, new)).distinct()
        new = longer.join(found, ["job", "ancestor"], "left_anti").checkpoint(eager=True)
        found = found.unionByName(new).checkpoint(eager=True)
    return found


def dependency_cycles(closure: DataFrame) -> DataFrame:
    """(job, cycle) of the jobs that reach themselves; ``cycle`` is the least job of those that reach each other."""
    back = closure.select(F.col("job").alias("ancestor"), F.col("ancestor").alias("job"))
    return closure.join(back, ["job", "ancestor"]).groupBy("job").agg(F.min("ancestor").alias("cycle"))
