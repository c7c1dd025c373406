"""Loops over edge tables.

Each round is written to the shared folder as Parquet, so the plan of a round
starts from files and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from heronlake.plans.shared import Rounds, scratch_path


def component_roots(edges: DataFrame) -> DataFrame:
    """Smallest reachable node for every node that has an edge: (id, component).

    Large-star and small-star rounds (Kiveris et al., 2014) turn each component
    into a star around its smallest node; the number of rounds grows with the
    logarithm of the longest path, not with its length.  The joins are plain
    joins on a node, which adaptive execution splits where one node is
    crowded.  The same pass that writes a round tells whether it changed.
    """
    u, v = F.greatest("src", "dst"), F.least("src", "dst")
    rounds = Rounds(edges.sparkSession, "components")
    stars = rounds.save(edges.where("src <> dst").select(u.alias("u"), v.alias("v")).distinct())
    seen = None
    while True:
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(lowest.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        state = Observation()
        stars = rounds.save(small.observe(
            state, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")
        ))
        if state.get == seen:
            break
        seen = state.get
    roots = stars.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots)


# Steps of a search after which edges to nodes that were found are left out.
STRETCH = 8


def reach(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """Fewest steps from any source to every node that can be reached: (id, steps).

    Each step adds its nodes to one folder, a part per step; nothing that was
    found before is written again.  Every ``STRETCH`` steps the edges to nodes
    found so far are left out for good, so a step compares with the parts since then
    alone and reads ever fewer edges; it never reads all that was found.
    """
    spark = edges.sparkSession
    base, rounds, step, first = scratch_path(spark, "reach"), Rounds(spark, "reach-edges"), 0, 0
    sources.select("id").distinct().write.parquet(f"{base}/steps=0")
    parts = lambda low, high: spark.read.schema("id long").parquet(*[f"{base}/steps={n}" for n in range(low, high + 1)])
    while True:
        frontier = parts(step, step)
        if frontier.isEmpty():
            return spark.read.schema("id long, steps int").parquet(base)
        ahead = frontier.join(edges, F.col("id") == F.col("src")).select(F.col("dst").alias("id")).distinct()
        if first <= step:
            ahead = ahead.join(parts(first, step), "id", "left_anti")
        ahead.write.parquet(f"{base}/steps={step + 1}")
        step += 1
        if step - first >= STRETCH:
            found = parts(first, step).withColumnRenamed("id", "dst")
            edges, first = rounds.save(edges.select("src", "dst").join(found, "dst", "left_anti").select("src", "dst")), step + 1


def is_acyclic(edges: DataFrame) -> bool:
    """Whether a directed edge table has no cycle.

    Every round drops edges that start at a node without a way in or end at
    one without a way out.  If there is none, every node left has a way in and
    a way out, so there is a cycle.  Then nodes with one way in become part of
    the node it comes from, and nodes with one way out part of the node it
    leads to: a cycle through such a node goes through the other as well, so
    none is lost and none is made, and an edge that so comes to lead to its own
    node closes one.  A coin says which of two neighbours gives way, so a fixed
    part of these nodes is gone after a round, and chains, trees and what they
    branch into take a number of rounds that grows with the logarithm of
    their length.  Where all nodes have several ways in and out, as on a
    ladder, one layer goes per round and side.
    """
    rounds, turn = Rounds(edges.sparkSession, "cycles"), 0

    def save(df: DataFrame) -> tuple[DataFrame, int, int]:
        seen = Observation()
        loops = F.count_if(F.col("src") == F.col("dst"))
        return rounds.save(df.observe(seen, F.count("*").alias("n"), loops.alias("loops"))), seen.get["n"], seen.get["loops"]

    left, count, loops = save(edges.select("src", "dst").distinct())
    while count and not loops:
        turn += 1
        leaving, coming = left.select(F.col("src").alias("dst")).distinct(), left.select(F.col("dst").alias("src")).distinct()
        kept = left.join(coming, "src", "left_semi").join(leaving, "dst", "left_semi").select("src", "dst")
        before, (kept, count, _) = count, save(kept)
        if count == before:
            return False
        coin = lambda c: F.pmod(F.xxhash64(F.col(c), F.lit(turn)), F.lit(2))  # noqa: B023,E731
        into = kept.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("n"), F.min("src").alias("other"))
        out = kept.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("n"), F.min("dst").alias("other"))
        gives = (F.col("n") == 1) & (coin("id") == 1) & (coin("other") == 0)
        one_in, one_out = (side.where(gives).select("id", "other") for side in (into, out))
        both = one_in.select("id", "other", F.lit(0).alias("side")).unionAll(one_out.select("id", "other", F.lit(1).alias("side")))
        moves = both.groupBy("id").agg(F.min(F.struct("side", "other")).alias("m")).select("id", "m.side", "m.other")
        inner = F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("id")).alias("src"), F.when(F.col("side") == 0, F.col("id")).otherwise(F.col("other")).alias("dst")
        rest = kept.join(moves.select(*inner), ["src", "dst"], "left_anti")
        name = lambda c: moves.select(F.col("id").alias(c), F.col("other").alias(f"_{c}"))
        named = rest.join(name("src"), "src", "left").join(name("dst"), "dst", "left")
        left, count, loops = save(named.select(F.coalesce("_src", "src").alias("src"), F.coalesce("_dst", "dst").alias("dst")).distinct())
    return not loops
