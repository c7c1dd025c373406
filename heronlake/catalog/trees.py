"""Forests, ancestors and search trees on the test tables."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import query
from heronlake.operators import trees as op
from heronlake.plans.ordered import order_buckets, row_numbers


def supplier_edges(t):
    """Pairs of suppliers on neighbouring lines of an order, in the order in which they first occur."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("a")).distinct()
    after = rows.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("a").alias("b"))
    pairs = rows.join(after, ["l_orderkey", "l_linenumber"]).where("a <> b")
    first = pairs.groupBy(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).agg(F.min("l_orderkey").alias("f"))
    order = ["f", "src", "dst"]
    return row_numbers(order_buckets(first, order), [], order, "pos").select("pos", "src", "dst")


@query("""with recursive s as (select distinct l_orderkey, l_linenumber, l_suppkey as k from lineitem),
          f as (select least(a.k, b.k) as src, greatest(a.k, b.k) as dst, min(a.l_orderkey) as f from s a join s b
              on a.l_orderkey = b.l_orderkey and b.l_linenumber = a.l_linenumber + 1 and a.k <> b.k group by 1, 2),
          e as materialized (select row_number() over (order by f, src, dst) as pos, src, dst from f),
          w(i, labels, closing, hit) as (
              select 0::bigint, range(0, (select max(s_suppkey) + 1 from supplier)), 0::bigint, null::bigint union all
              select i + 1, case when labels[src + 1] = labels[dst + 1] then labels
                  else list_transform(labels, lambda x: case when x = labels[src + 1] then labels[dst + 1] else x end) end,
                  closing + (labels[src + 1] = labels[dst + 1])::int,
                  coalesce(hit, case when labels[src + 1] = labels[dst + 1] then pos end) from w join e on e.pos = i + 1)
          select pos, src, dst, closing as closing_edges, i - closing as forest_edges
          from (select * from w order by i desc limit 1) join e on pos = hit""")
def first_cycle_edge(t):
    return op.first_cycle_edge(supplier_edges(t))


@query("""with recursive up(id, anc, d) as (select c_custkey, c_custkey, 0 from customer union all
              select id, anc // 7, d + 1 from up where anc > 0),
          p as (select distinct x.o_custkey as a, y.o_custkey as b from orders x join orders y on y.o_orderkey = x.o_orderkey + 1)
          select a, b, arg_min(x.anc, x.d) as ancestor from p join up x on x.id = a join up y on y.id = b and y.anc = x.anc
          group by 1, 2""")
def common_ancestors(t):
    tree = t.customer.selectExpr("c_custkey as id", "c_custkey div 7 as parent")
    after = t.orders.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_custkey").alias("b"))
    return op.common_ancestors(tree, t.orders.select("o_orderkey", F.col("o_custkey").alias("a")).join(after, "o_orderkey"))


@query("""with recursive n as (select c_nationkey as k, row_number() over (partition by c_nationkey order by c_custkey) as i,
              c_acctbal from customer),
          t as (select k, i, case when k % 3 = 1 then c_acctbal
              else (2 * i + 1) / (2.0 ** (floor(log2(i)) + 1)) - 2 + (k % 3 = 2 and i = 5)::int end as v from n),
          w(k, i, v, low, high) as (select k, i, v, '-infinity'::double, 'infinity'::double from t where i = 1 union all
              select t.k, t.i, t.v, case when t.i % 2 = 0 then low else greatest(low, w.v) end,
                  case when t.i % 2 = 0 then least(high, w.v) else high end from w join t on t.k = w.k and t.i // 2 = w.i)
          select k * 4294967296 + 1 as root, count(*) as nodes, bool_and(v > low and v < high) as is_search_tree from w group by k""")
def search_tree_check(t):
    order = ["c_custkey"]
    n = row_numbers(order_buckets(t.customer.select("c_nationkey", "c_custkey", "c_acctbal"), order, ["c_nationkey"]), ["c_nationkey"], order, "i")
    k, i, deep = F.col("c_nationkey"), F.col("i"), F.floor(F.log2("i"))
    even = (2 * i + 1) / F.pow(F.lit(2.0), deep + 1) - 2 + ((k % 3 == 2) & (i == 5)).cast("int")
    name = lambda x: k.cast("long") * F.lit(1 << 32) + x
    return op.search_tree_check(n.select(
        name(i).alias("id"), F.when(i > 1, name(F.floor(i / 2))).alias("parent"), (i % 2 == 0).alias("is_left"),
        F.when(k % 3 == 1, F.col("c_acctbal")).otherwise(even).cast("double").alias("value"),
    ))
