"""Sorts and top-k on the test tables."""


from heronlake.catalog.registry import query, r
from heronlake.operators import topk as op
from heronlake.sources.views import nation_flows


@query("""select max(s_acctbal) as nth_highest from (select s_acctbal, dense_rank() over
          (order by s_acctbal desc) as k from supplier) where k = 3""")
def nth_highest_salary(t):
    return op.nth_highest_salary(t.supplier.selectExpr("s_acctbal as salary"), 3)


@query("""select min(p) as kth_largest from (select l_extendedprice as p from lineitem
          order by l_extendedprice desc limit 25)""")
def kth_largest(t):
    return op.kth_largest(t.lineitem, "l_extendedprice", 25)


@query("""select id, count(*) as num from (select buyer_nation as id from flows union all
          select seller_nation from flows) group by 1 order by num desc, id limit 1""", views="flows")
def most_friends(t):
    return op.most_friends(
        nation_flows(t).selectExpr("buyer_nation as requester_id", "seller_nation as accepter_id")
    )


@query(f"""select * from (select 'user_' || user_id as results from events group by 1
               order by count(*) desc, results limit 1)
           union all select * from (select event_type from events where strftime(ts, '%Y-%m') = '2024-01'
               group by 1 order by {r('avg(floor(value) % 5)', 6)} desc, event_type limit 1)""")
def movie_rating(t):
    ratings = t.events.selectExpr("user_id", "event_type as movie_id", "floor(value) % 5 as rating", "ts as created_at")
    return op.movie_rating(
        ratings, t.events.selectExpr("user_id", "concat('user_', user_id) as name").distinct(),
        t.events.selectExpr("event_type as movie_id", "event_type as title").distinct(), "2024-01",
    )


@query("select o_orderkey, o_totalprice from orders")
def sort_desc(t):
    return op.sort_desc(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@query("select event_id, ts, user_id from events order by event_id limit 5")
def ordered_head(t):
    return op.ordered_head(t.events, "event_id", 5, ["event_id", "ts", "user_id"])


@query("""with h as (select cast(hour(pickup_ts) as int) as hour, count(*) as trips from trips group by 1)
          select * from (select *, 'busiest' as kind from h order by trips desc, hour limit 5)
          union all select * from (select *, 'quietest' as kind from h order by trips, hour limit 5)""",
       views="trips")
def busiest_hours(t):
    return op.busiest_hours(t.trips)
