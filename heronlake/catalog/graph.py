"""Graph jobs on the test tables."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import query
from heronlake.operators import graph as op
from heronlake.sources.views import consecutive_pairs, nation_flows, next_order_edges


@query("""with f as (select user1_id as a, user2_id as b from part_links union all
              select user2_id, user1_id from part_links)
          select p.user1_id, p.user2_id, count(*) as common_friend from part_links p
          join f x on x.a = p.user1_id join f y on y.a = p.user2_id and y.b = x.b
          group by 1, 2 having count(*) >= 3""", views="line_rows part_links")
def mutual_friends(t):
    return op.mutual_friends(consecutive_pairs(t.lineitem, "l_partkey"), 3)


@query("""with f as (select user1_id as u, user2_id as f from part_links union
              select user2_id, user1_id from part_links),
          l as (select distinct l_partkey as u, l_suppkey as p from lineitem)
          select f.u as user_id, l.p as page_id, count(distinct f.f) as friends_likes from f join l on l.u = f.f
          where not exists (select 1 from l o where o.u = f.u and o.p = l.p) group by 1, 2""",
       views="line_rows part_links")
def page_recommendations(t):
    return op.page_recommendations(
        consecutive_pairs(t.lineitem, "l_partkey"), t.lineitem.selectExpr("l_partkey as user_id", "l_suppkey as page_id")
    )


@query("""select a.buyer_nation as follower, count(distinct b.buyer_nation) as num
          from (select distinct buyer_nation from flows) a join flows b on b.seller_nation = a.buyer_nation
          group by 1""", views="flows")
def second_degree(t):
    return op.second_degree(nation_flows(t).selectExpr("buyer_nation as follower", "seller_nation as followee"))


@query("select o_orderkey as id, min(o_orderkey) over (partition by o_custkey) as component from orders")
def connected_components(t):
    return op.connected_components(t.orders.selectExpr("o_orderkey as id"), next_order_edges(t.orders))


@query("""with recursive d(id) as (select 0::bigint union all select c_custkey from customer join d
              on c_custkey // 7 = d.id and c_custkey > 0)
          select count(*) as nodes, count(*) - (select count(*) from d) + 1 as components,
          (select count(*) from customer where c_custkey > 0) as edges,
          count(*) = (select count(*) from d) as is_tree from customer""")
def is_tree(t):
    edges = t.customer.where("c_custkey > 0").selectExpr("c_custkey as src", "c_custkey div 7 as dst")
    return op.is_tree(t.customer.selectExpr("c_custkey as id"), edges)


NEXT = "abs(a.r - b.r) + abs(a.c - b.c) = 1"


@query(f"""with recursive l as (select * from grid where v >= 16),
           w(r, c, k) as (select r, c, r * 100 + c from l union
               select b.r, b.c, a.k from w a join l b on {NEXT})
           select count(distinct k) as islands from (select r, c, min(k) as k from w group by 1, 2)""", views="grid")
def grid_islands(t):
    return op.grid_islands(t.grid, 16)


@query(f"""with recursive p as (select * from grid where v >= 12),
           w(r, c, n) as (select r, c, 0 from p where v >= 20 union
               select b.r, b.c, a.n + 1 from w a join p b on {NEXT} where a.n < 60),
           s as (select r, c, min(n) as n from w group by 1, 2)
           select case when (select count(*) from s) = (select count(*) from p) then (select coalesce(max(n), 0) from s)
               else -1 end as minutes""", views="grid")
def spread_minutes(t):
    return op.spread_minutes(t.grid, 12, 20)


def climb(start: str) -> str:
    return f"""(select r, c, v from grid where {start} union
        select b.r, b.c, b.v from w a join grid b on {NEXT} and b.v >= a.v)"""


@query(f"""with recursive p(r, c, v) as {climb('r = 0 or c = 0').replace('from w a', 'from p a')},
           q(r, c, v) as {climb('r = (select max(r) from grid) or c = 23').replace('from w a', 'from q a')}
           select r, c, v from p intersect select r, c, v from q""", views="grid")
def reach_both(t):
    return op.reach_both(t.grid)


@query("""with recursive looped as (select src, dst from order_chain
              union all (select dst, src from order_chain order by src limit 1)),
          w(s, d) as (select src, dst from order_chain union select w.s, e.dst from w join order_chain e on e.src = w.d),
          x(s, d) as (select src, dst from looped union select x.s, e.dst from x join looped e on e.src = x.d)
          select 'chain' as dependencies, (select count(*) from order_chain) as edges,
              not exists (select 1 from w where s = d) as can_finish
          union all select 'chain and a way back', (select count(*) from looped), not exists (select 1 from x where s = d)""",
       views="order_chain")
def has_no_cycle(t):
    chain = next_order_edges(t.orders)
    back = chain.orderBy("src").limit(1).selectExpr("dst as src", "src as dst")
    plain = op.has_no_cycle(chain).withColumn("dependencies", F.lit("chain"))
    looped = op.has_no_cycle(chain.unionAll(back)).withColumn("dependencies", F.lit("chain and a way back"))
    return plain.unionByName(looped)


@query("""with recursive d(id, depth) as (select 0::bigint, 0::bigint union all select c_custkey, d.depth + 1
              from customer join d on c_custkey // 7 = d.id and c_custkey > 0)
          select depth, count(*) as nodes, (select max(depth) from d) as max_depth from d group by 1""")
def hierarchy_levels(t):
    return op.hierarchy_levels(t.customer.selectExpr("c_custkey as id", "c_custkey div 7 as parent"))
