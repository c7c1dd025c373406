"""Brackets, stretches, windows, palindromes, word cuts and letter grids on the test tables."""

from pyspark.sql import functions as F

from heronlake.catalog.registry import query
from heronlake.operators import sequences as op, text

KEY, ORDER = ["user_id"], ["ts", "event_id"]
W = "partition by user_id order by ts, event_id"


@query("""with c as (select page_id, list_filter(string_split(html, ''), lambda c: contains('([{<)]}>', c) and c <> '') as cs from pages),
          d as (select page_id, max(d) as deepest from (select page_id, sum(case when contains('([{<', c) then 1 else -1 end)
              over (partition by page_id order by i) as d from (select page_id, unnest(cs) as c, generate_subscripts(cs, 1) as i from c)) group by 1)
          select c.page_id, len(cs) as brackets, greatest(coalesce(deepest, 0), 0)::bigint as deepest,
          list_reduce(list_concat([''], cs), lambda s, c: case when contains('([{<', c) then s || c
              when s <> '' and right(s, 1) = translate(c, ')]}>', '([{<') then left(s, length(s) - 1) else s || '#' end) = '' as is_balanced
          from c left join d using (page_id)""")
def bracket_report(t):
    return op.bracket_report(t.pages, "page_id", "html")


@query(f"""with n as (select user_id, floor(value / 5) as v, row_number() over ({W}) as rn from events)
           select user_id, max(length) as longest from (select a.user_id, a.rn, a.rn - coalesce(max(c.rn), 0) as length from n a
               left join (select x.user_id, x.rn, y.rn as again from n x join n y on x.user_id = y.user_id and x.v = y.v and x.rn < y.rn) c
               on c.user_id = a.user_id and c.again <= a.rn group by 1, 2) group by 1""")
def longest_distinct_run(t):
    rows = t.events.select("user_id", *ORDER, F.floor(F.col("value") / 5).alias("v"))
    return op.longest_distinct_run(rows, KEY, ORDER, "v")


@query(f"""with n as (select user_id, row_number() over ({W}) as rn, event_type = 'click' as c, event_type = 'view' as v,
               event_type = 'error' as e from events),
           p as (select user_id, rn, c, v, e, sum(c::int) over w as nc, sum(v::int) over w as nv, sum(e::int) over w as ne from n
               window w as (partition by user_id order by rn)),
           b as (select a.user_id, min(struct_pack(l := z.rn - a.rn + 1, f := a.rn)) as b from p a join p z on z.user_id = a.user_id
               and z.rn >= a.rn and z.nc - a.nc + a.c::int >= 2 and z.nv - a.nv + a.v::int >= 1 and z.ne - a.ne + a.e::int >= 1 group by 1)
           select user_id, b.f as first_row, b.l as length from (select distinct user_id from events) left join b using (user_id)""")
def covering_window(t):
    rows = t.events.select("user_id", *ORDER, "event_type")
    return op.covering_window(rows, KEY, ORDER, "event_type", {"click": 2, "view": 1, "error": 1})


@query("""with recursive l as (select concat(conv_id, ':', turn) as id, string_split(coalesce(text, ''), '') as cs, text from conversations),
          ch as materialized (select id, unnest(cs) as c, generate_subscripts(cs, 1) - 1 as i from l where text <> ''),
          w(id, low, high) as (select id, i, i from ch union all
              select a.id, a.i, b.i from ch a join ch b on a.id = b.id and b.i = a.i + 1 and a.c = b.c union all
              select w.id, a.i, b.i from w join ch a on a.id = w.id and a.i = w.low - 1
              join ch b on b.id = w.id and b.i = w.high + 1 and a.c = b.c),
          m as (select id, min(struct_pack(n := low - high, s := low)) as m from w group by 1)
          select id, coalesce(m.s, 0)::bigint as start, coalesce(1 - m.n, 0)::bigint as length from l left join m using (id)""")
def longest_palindrome(t):
    named = t.conversations.select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "text")
    return op.longest_palindrome(named, "id", "text")


@query("""with recursive q as (select item_id, regexp_replace(lower(text), '[^\\p{L}]', '', 'g') as s from benchmark),
          n as (select distinct length(word) as n from words),
          p as (select item_id, length(s) as size, unnest(range(0, length(s))) as b, s from q),
          e as (select item_id, b, b + n as goal from p join n on b + n <= size semi join words on word = substr(s, (b + 1)::int, n::int)),
          w(item_id, b) as (select item_id, 0::bigint from q union select w.item_id, goal from w join e on e.item_id = w.item_id and e.b = w.b)
          select item_id, (select count(*) from e where e.item_id = q.item_id) as words_found,
          exists (select 1 from w where w.item_id = q.item_id and w.b = length(s)) as can_cut from q""", views="words")
def word_cuts(t):
    joined = t.benchmark.select("item_id", F.regexp_replace(F.lower("text"), r"[^\p{L}]", "").alias("s"))
    return op.word_cuts(joined, text.words(t.documents, "text"), "item_id", "s")


@query("""with recursive g as (select r, c, chr(97 + (v % 26)::int) as l from grid),
          p as (select distinct left(word, n::int) as s from (select word, unnest(generate_series(1, length(word))) as n from words)),
          w(r, c, s, path) as (select r, c, l, [r * 100 + c] from g where l in (select s from p) union all
              select b.r, b.c, w.s || b.l, list_append(path, b.r * 100 + b.c) from w join g b on abs(w.r - b.r) + abs(w.c - b.c) = 1
              where not list_contains(path, b.r * 100 + b.c) and w.s || b.l in (select s from p))
          select s as word, count(*) as paths from w where s in (select word from words) group by 1""", views="grid words")
def words_on_grid(t):
    board = t.grid.select("r", "c", F.chr(97 + F.col("v") % 26).alias("letter"))
    return op.words_on_grid(board, text.words(t.documents, "text"))
