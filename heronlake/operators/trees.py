"""Spanning forests, common ancestors and search-tree checks over edge and parent tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from heronlake.operators.graph import node_depths
from heronlake.plans.graph import component_roots
from heronlake.plans.shared import Rounds, cut_lineage, scratch_path


def spanning_forest(edges: DataFrame) -> DataFrame:
    """Positions (pos) of the edges that join two parts when edges are taken in order of ``pos``.

    ``edges`` has (pos, src, dst), each position once.  Every round, each part
    takes its first edge to another part; the parts these edges join become
    one.  A part at least doubles, so rounds grow with the logarithm of the
    nodes.  Between two parts only the first edge goes on to the next round.
    """
    spark = edges.sparkSession
    rounds, found = Rounds(spark, "forest"), scratch_path(spark, "forest-edges")
    left = rounds.save(edges.where("src <> dst").select("pos", F.col("src").alias("u"), F.col("dst").alias("v")))
    left.select("pos").limit(0).write.parquet(f"{found}/turn=-1")
    turn = 0
    while not left.isEmpty():
        ends = left.select("pos", F.explode(F.array("u", "v")).alias("part"))
        picked = ends.groupBy("part").agg(F.min("pos").alias("pos")).select("pos").distinct()
        picked.write.parquet(f"{found}/turn={turn}")
        taken = spark.read.schema(picked.schema).parquet(f"{found}/turn={turn}")
        bridges = left.join(taken, "pos", "left_semi").select(F.col("u").alias("src"), F.col("v").alias("dst"))
        roots = component_roots(bridges)
        name = lambda c: roots.select(F.col("id").alias(c), F.col("component").alias(f"_{c}"))
        moved = left.join(name("u"), "u").join(name("v"), "v").where("_u <> _v")
        low, high = F.least("_u", "_v"), F.greatest("_u", "_v")
        left = rounds.save(moved.groupBy(low.alias("u"), high.alias("v")).agg(F.min("pos").alias("pos")).select("pos", "u", "v"))
        turn += 1
    return spark.read.schema(edges.select("pos").schema).parquet(found).select("pos")


def first_cycle_edge(edges: DataFrame) -> DataFrame:
    """The first edge, in order of ``pos``, that closes a cycle: (pos, src, dst, forest_edges, closing_edges).

    An edge closes a cycle exactly if it is not in the forest by position.  An
    edge from a node to itself closes one.  Without a cycle there is no row.
    """
    forest = cut_lineage(spanning_forest(edges))
    closing = edges.join(forest, "pos", "left_anti")
    first = closing.agg(F.min(F.struct("pos", "src", "dst")).alias("e"), F.count("*").alias("closing_edges"))
    kept = forest.agg(F.count("*").alias("forest_edges"))
    return first.where("e is not null").select("e.*", "closing_edges").withColumn("forest_edges", kept.scalar())


def _parents(tree: DataFrame) -> DataFrame:
    linked = F.col("parent").isNotNull() & (F.col("parent") != F.col("id"))
    return tree.where(linked).select("id", F.col("parent").alias("up"))


def ancestor_table(tree: DataFrame, levels: int) -> list[DataFrame]:
    """For k from 0 the table (id, up) of ancestors 2^k above; nodes without one are left out."""
    spark, base = tree.sparkSession, scratch_path(tree.sparkSession, "ancestors")
    tables, ups = [], _parents(tree)
    for k in range(levels):
        ups.write.parquet(f"{base}/k={k}")
        ups = spark.read.schema(ups.schema).parquet(f"{base}/k={k}")
        tables.append(ups)
        above = ups.select(F.col("id").alias("up"), F.col("up").alias("_up"))
        ups = ups.join(above, "up").select("id", F.col("_up").alias("up"))
    return tables


def common_ancestors(tree: DataFrame, pairs: DataFrame) -> DataFrame:
    """Lowest common ancestor of every pair: (a, b, ancestor).

    ``tree`` has (id, parent), ``pairs`` (a, b).  All pairs are lifted together: first
    the deeper node by the bits of the difference in depth, then both by
    falling powers of two as long as they stay apart.  Joins grow with the
    logarithm of the depth, the rows with the pairs.  Pairs in different trees
    or with an unknown node have no ancestor (null); nodes on or below a
    cycle of parents are unknown.
    """
    depths = cut_lineage(node_depths(tree))
    deepest = depths.agg(F.max("depth")).first()[0] or 0
    tables, rounds = ancestor_table(tree.join(depths, "id", "left_semi"), max(1, int(deepest).bit_length())), Rounds(tree.sparkSession, "lifted")
    depth = lambda c: depths.select(F.col("id").alias(c), F.col("depth").alias(f"_d{c}"))
    asked = pairs.select("a", "b").distinct()
    first = asked.join(depth("a"), "a").join(depth("b"), "b")
    deeper = F.col("_da") >= F.col("_db")
    state = rounds.save(first.select(
        "a", "b", F.when(deeper, F.col("a")).otherwise(F.col("b")).alias("x"), F.when(deeper, F.col("b")).otherwise(F.col("a")).alias("y"),
        F.abs(F.col("_da") - F.col("_db")).alias("gap"),
    ))
    for k in range(len(tables)):
        # nodes with this bit go up; the others keep their place
        step = tables[k].select(F.col("id").alias("x"), F.col("up").alias("_x"))
        goes = F.shiftright("gap", k).bitwiseAND(F.lit(1).cast("long")) == 1
        state = rounds.save(state.where(goes).join(step, "x").select("a", "b", F.col("_x").alias("x"), "y", "gap").unionAll(
            state.where(~goes).select("a", "b", "x", "y", "gap")
        ))
    for k in reversed(range(len(tables))):
        apart = state.where("x <> y")
        up = lambda c: tables[k].select(F.col("id").alias(c), F.col("up").alias(f"_{c}"))  # noqa: B023,E731
        both = apart.join(up("x"), "x", "left").join(up("y"), "y", "left")
        moves = F.coalesce(F.col("_x") != F.col("_y"), F.lit(False))
        both = both.select("a", "b", F.when(moves, F.col("_x")).otherwise(F.col("x")).alias("x"), F.when(moves, F.col("_y")).otherwise(F.col("y")).alias("y"), "gap")
        state = rounds.save(both.unionAll(state.where("x = y")))
    parent = lambda c: tables[0].select(F.col("id").alias(c), F.col("up").alias(f"_{c}"))
    ends = state.join(parent("x"), "x", "left").join(parent("y"), "y", "left")
    meet = F.when(F.col("x") == F.col("y"), F.col("x")).when(F.col("_x") == F.col("_y"), F.col("_x"))
    found = ends.select(F.col("a").alias("_a"), F.col("b").alias("_b"), meet.alias("ancestor"))
    out = asked.join(found, F.col("a").eqNullSafe(F.col("_a")) & F.col("b").eqNullSafe(F.col("_b")), "left")
    return out.select("a", "b", "ancestor")


def search_tree_check(tree: DataFrame) -> DataFrame:
    """Whether each tree is a search tree: (root, nodes, is_search_tree).

    ``tree`` has (id, parent, is_left, value).  A left child bounds its
    subtree from above by its parent's value, a right child from below.  The
    bounds of a path are the tightest of its parts, so they are put together
    while pointers double: every node knows a stretch of its way up, and takes
    over the stretch of the node it points to.  Values must lie strictly
    between their bounds; a null value does not.  Nodes on or below a cycle of
    parents have no root and are left out.
    """
    linked = F.col("parent").isNotNull() & (F.col("parent") != F.col("id"))
    nodes = tree.select("id", F.when(linked, F.col("parent")).alias("up"), "is_left", "value")
    above = nodes.select(F.col("id").alias("up"), F.col("value").alias("_bound"), F.lit(True).alias("_known"))
    rounds = Rounds(tree.sparkSession, "bounds")
    first = nodes.join(above, "up", "left")
    state = rounds.save(first.select(
        "id", "value", F.when(F.col("_known"), F.col("up")).alias("up"), F.coalesce(F.when(F.col("_known"), F.col("up")), F.col("id")).alias("root"),
        F.when(~F.col("is_left"), F.col("_bound")).alias("low"), F.when(F.col("is_left"), F.col("_bound")).alias("high"),
    ))
    left = None
    while True:
        open_ = state.where("up is not null")
        before, left = left, open_.count()
        if left in (0, before):
            break
        step = state.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("root").alias("_root"), F.col("low").alias("_low"), F.col("high").alias("_high"))
        # what points at a root is done: its stretch reaches the top
        moved = open_.join(step, "up").select(
            "id", "value", F.col("_up").alias("up"), F.col("_root").alias("root"), F.greatest("low", "_low").alias("low"), F.least("high", "_high").alias("high")
        )
        state = rounds.save(state.where("up is null").unionAll(moved))
    fits = (F.col("low").isNull() | (F.col("value") > F.col("low"))) & (F.col("high").isNull() | (F.col("value") < F.col("high")))
    wrong = F.col("value").isNull() | ~fits
    done = state.where("up is null")
    return done.groupBy("root").agg(F.count("*").alias("nodes"), (F.count_if(wrong) == 0).alias("is_search_tree"))
