"""Friends, recommendations, components, grids, dependencies, hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heronlake.plans.graph import component_roots, is_acyclic, reach
from heronlake.plans.lists import WHOLE, count_by_lists
from heronlake.plans.shared import Rounds, cut_lineage

# Second ends per task that one end of a wedge is paired with.
FAN = 1024


def turned(friendship: DataFrame) -> DataFrame:
    """Friendship rows in both directions as (user_id, friend_id), the table worked out once."""
    way = lambda a, b: F.struct(F.col(a).alias("user_id"), F.col(b).alias("friend_id"))
    return friendship.select(F.inline(F.array(way("user1_id", "user2_id"), way("user2_id", "user1_id"))))


def both_ways(friendship: DataFrame) -> DataFrame:
    """Friendship rows in both directions as (user_id, friend_id), each once."""
    return turned(friendship).distinct()


def mutual_friends(friendship: DataFrame, k: int = 3) -> DataFrame:
    """Friends who share at least k common friends.

    Each friendship is pointed from the person with fewer friends to the one
    with more.  Nobody then has more than sqrt(2 x friendships) outgoing
    links, so a very popular person does not multiply the wedges, and each
    triangle is met once and counted for its three sides.  The first ends of a
    person's wedges are dealt over as many parts as there are links to pair
    them with, so no task pairs all links of one person.
    """
    pairs = both_ways(friendship).where("user_id <> friend_id")
    edges = cut_lineage(pairs.where("user_id < friend_id").select(
        F.col("user_id").alias("a"), F.col("friend_id").alias("b")
    ))
    degree = edges.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("d"))
    degree = cut_lineage(degree)
    at = lambda c: degree.select(F.col("id").alias(c), F.col("d").alias(f"d{c}"))
    ranked = edges.join(at("a"), "a").join(at("b"), "b")
    up = F.struct("da", "a") < F.struct("db", "b")
    links = cut_lineage(ranked.select(
        F.when(up, F.col("a")).otherwise(F.col("b")).alias("lo"), F.when(up, F.col("b")).otherwise(F.col("a")).alias("hi")
    ))
    parts = links.groupBy("lo").agg(F.ceil(F.count("*") / FAN).alias("parts"))
    dealt = links.join(parts, "lo")
    first = dealt.select("lo", F.pmod(F.xxhash64("hi"), F.col("parts")).alias("part"), F.col("hi").alias("x"))
    second = dealt.select("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("hi").alias("y"))
    wedges = first.join(second, ["lo", "part"])
    wedges = wedges.where("x < y")
    closed = wedges.join(edges, (F.col("x") == F.col("a")) & (F.col("y") == F.col("b")))
    sides = closed.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.least(p, q).alias("user1_id"), F.greatest(p, q).alias("user2_id"))
                    for p, q in (("lo", "x"), ("lo", "y"), ("x", "y"))
                ]
            )
        ).alias("e")
    ).select("e.*")
    counts = sides.groupBy("user1_id", "user2_id").agg(F.count("*").alias("common_friend"))
    return counts.where(F.col("common_friend") >= k)


def page_recommendations(friendship: DataFrame, likes: DataFrame) -> DataFrame:
    """Pages liked by friends and not by oneself, with the number of such friends.

    Everybody's pages go to their friends as one packed list, and to oneself,
    so what is shuffled is a byte or two per friend and page, and nothing is
    written for the pairs (user, page) that come out.  Ids that are not whole
    numbers are joined row by row.
    """
    links, liked = turned(friendship), likes.select("user_id", "page_id")
    user, page = links.schema["user_id"].dataType, liked.schema["page_id"].dataType
    if {user.simpleString(), page.simpleString(), liked.schema["user_id"].dataType.simpleString()} <= WHOLE:
        groups = links.select(F.col("friend_id").alias("id"), F.col("user_id").alias("group"))
        counts = count_by_lists(groups, liked.select(F.col("user_id").alias("id"), F.col("page_id").alias("item")))
        return counts.select(
            F.col("group").cast(user).alias("user_id"), F.col("item").cast(page).alias("page_id"), F.col("count").alias("friends_likes")
        )
    liked = liked.distinct()
    theirs = liked.select(F.col("user_id").alias("friend_id"), "page_id")
    counts = both_ways(friendship).join(theirs, "friend_id").groupBy("user_id", "page_id").agg(F.count("*").alias("friends_likes"))
    return counts.join(liked, ["user_id", "page_id"], "left_anti")


def second_degree(follow: DataFrame) -> DataFrame:
    """People who follow someone and are followed, with their follower count."""
    followers = follow.groupBy(F.col("followee").alias("person")).agg(F.count_distinct("follower").alias("num"))
    active = follow.select(F.col("follower").alias("person")).distinct()
    return followers.join(active, "person", "left_semi").select(F.col("person").alias("follower"), "num")


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Component (its smallest id) of every node; a node without edges is its own."""
    roots = component_roots(edges)
    return nodes.select("id").distinct().join(roots, "id", "left").select(
        "id", F.coalesce("component", "id").alias("component")
    )


def is_tree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Whether n nodes are joined into one component by n-1 edges."""
    parts = connected_components(nodes, edges).agg(
        F.count("*").alias("nodes"), F.count_if(F.col("id") == F.col("component")).alias("components")
    )
    count = edges.agg(F.count("*")).scalar()
    return parts.withColumn("edges", count).withColumn(
        "is_tree", (F.col("edges") == F.col("nodes") - 1) & (F.col("components") == 1)
    )


def _cell(r: str = "r", c: str = "c"):
    return (F.col(r).cast("long") * F.lit(1 << 32) + F.col(c)).alias("id")


def grid_edges(grid: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Neighbouring cells (src, dst) in both directions, with chosen columns of each."""
    columns = columns or []
    steps = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in ((0, 1), (0, -1), (1, 0), (-1, 0))])
    here = grid.select(
        "r", "c", *[F.col(x).alias(f"src_{x}") for x in columns], F.explode(steps).alias("s")
    ).select(
        _cell().alias("src"), *[f"src_{x}" for x in columns],
        (F.col("r") + F.col("s.dr")).alias("r"), (F.col("c") + F.col("s.dc")).alias("c"),
    )
    there = grid.select("r", "c", *[F.col(x).alias(f"dst_{x}") for x in columns])
    return here.join(there, ["r", "c"]).withColumn("dst", _cell()).drop("r", "c")


def grid_islands(grid: DataFrame, land: int = 1) -> DataFrame:
    """Number of four-neighbour regions of cells at or above the land value."""
    cells = grid.where(F.col("v") >= land)
    edges = grid_edges(cells).where("src < dst").select("src", "dst")
    regions = connected_components(cells.select(_cell()), edges)
    return regions.agg(F.count_if(F.col("id") == F.col("component")).alias("islands"))


def spread_minutes(grid: DataFrame, passable: int, source: int) -> DataFrame:
    """Steps until every passable cell is reached, -1 when some never is."""
    cells = grid.where(F.col("v") >= passable).withColumn("id", _cell())
    edges = cut_lineage(grid_edges(cells).select("src", "dst"))
    steps = reach(edges, cells.where(F.col("v") >= source))
    reached = steps.agg(F.count("*").alias("n"), F.coalesce(F.max("steps"), F.lit(0)).alias("steps"))
    everything = cells.agg(F.count("*")).scalar()
    return reached.select(F.when(F.col("n") == everything, F.col("steps")).otherwise(-1).alias("minutes"))


def reach_both(grid: DataFrame) -> DataFrame:
    """Cells from which water can run to the top-left and to the bottom-right border.

    The search runs uphill from each border; the answer is the intersection.
    """
    cells = grid.withColumn("id", _cell())
    uphill = cut_lineage(grid_edges(grid, ["v"]).where("dst_v >= src_v").select("src", "dst"))
    size = grid.agg(F.struct(F.max("r").alias("r"), F.max("c").alias("c"))).scalar()
    edge = cells.withColumn("m", size)
    first = reach(uphill, edge.where("r = 0 or c = 0").select("id"))
    second = reach(uphill, edge.where("r = m.r or c = m.c").select("id"))
    both = first.select("id").intersect(second.select("id"))
    return cells.join(both, "id", "left_semi").select("r", "c", "v")


def has_no_cycle(deps: DataFrame) -> DataFrame:
    """Whether tasks can be ordered so that each one follows what it needs."""
    verdict = is_acyclic(deps)
    return deps.agg(F.count("*").alias("edges")).withColumn("can_finish", F.lit(verdict))


def node_depths(tree: DataFrame) -> DataFrame:
    """Depth of every node of a parent table (id, parent); roots are at 0.

    Every node keeps a pointer upward and its distance; following the pointer
    of the pointer doubles the distance, so the rounds grow with the logarithm
    of the depth.  Parents that form a cycle have no root above them: once a
    round settles no node, what is left lies on or below a cycle and has no
    depth, as in a recursive statement that starts at the roots.
    """
    has_parent = F.col("parent").isNotNull() & (F.col("parent") != F.col("id"))
    rounds = Rounds(tree.sparkSession, "depths")
    nodes = rounds.save(tree.select(
        "id", F.when(has_parent, F.col("parent")).alias("up"), F.when(has_parent, 1).otherwise(0).cast("long").alias("depth")
    ))
    left = None
    while True:
        open_nodes = nodes.where("up is not null")
        before, left = left, open_nodes.count()
        if left in (0, before):
            return nodes.where("up is null").select("id", "depth")
        above = nodes.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_d"))
        moved = open_nodes.join(above, "up").select(
            "id", F.col("_up").alias("up"), (F.col("depth") + F.col("_d")).alias("depth")
        )
        nodes = rounds.save(nodes.where("up is null").unionAll(moved))


def hierarchy_levels(tree: DataFrame) -> DataFrame:
    """Nodes per depth and the largest depth."""
    levels = node_depths(tree).groupBy("depth").agg(F.count("*").alias("nodes"))
    return levels.withColumn("max_depth", levels.agg(F.max("depth")).scalar())
