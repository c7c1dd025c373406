"""Words and texts of the test tables."""

from heronlake.catalog.registry import query
from heronlake.operators import text as op


@query("""select array_to_string(list_sort(string_split(word, '')), '') as letters,
          string_agg(word, ' ' order by word) as words, count(*) as n from words group by 1""", views="words")
def group_anagrams(t):
    return op.group_anagrams(op.words(t.documents, "text"))


@query("select word, word = reverse(word) as is_palindrome from words", views="words")
def palindrome_flag(t):
    return op.words(t.documents, "text").select("word", op.palindrome_flag("word").alias("is_palindrome"))


@query("select doc_id, cast(length(string_split(rtrim(text, ' '), ' ')[-1]) as int) as last_length from documents")
def last_word_length(t):
    return t.documents.select("doc_id", op.last_word_length("text").alias("last_length"))


@query("select doc_id, cast(strpos(text, 'the') - 1 as int) as found_at from documents")
def find_substring(t):
    return t.documents.select("doc_id", op.find_substring("text", "the").alias("found_at"))


@query("""with n as (select item_id as k, unnest(string_split(text, '')) as c from benchmark),
          m as (select doc_id as k, unnest(string_split(text, '')) as c from documents
              where doc_id in (select item_id from benchmark)),
          a as (select k, c, count(*) as need from n group by 1, 2),
          b as (select k, c, count(*) as have from m group by 1, 2)
          select item_id as k, item_id not in (select k from a left join b using (k, c)
              where have is null or have < need) as ok from benchmark where item_id in (select doc_id from documents)""")
def can_construct(t):
    return op.can_construct(
        t.benchmark.selectExpr("item_id as k", "text as note"), t.documents.selectExpr("doc_id as k", "text as magazine"),
        "k",
    )


@query("""with q as (select distinct word from (select unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) as word
              from benchmark) where word <> ''),
          p as (select distinct left(word, cast(n as int)) as word from (select word, unnest(generate_series(1, length(word)))
              as n from words))
          select word, word in (select word from words) as is_word, word in (select word from p) as is_prefix from q""",
       views="words")
def prefix_lookup(t):
    return op.prefix_lookup(op.words(t.documents, "text"), op.words(t.benchmark, "text"))
