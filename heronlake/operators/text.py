"""Words and texts: whole values, built-in string functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def words(df: DataFrame, text: str) -> DataFrame:
    """Distinct lower-case words of a text column."""
    parts = F.split(F.lower(F.col(text)), r"[^\p{L}]+")
    return df.select(F.explode(parts).alias("word")).where("word <> ''").distinct()


def group_anagrams(vocabulary: DataFrame) -> DataFrame:
    """Words made of the same letters, one row per set of letters."""
    letters = F.array_join(F.array_sort(F.split("word", "")), "")
    return vocabulary.select("word").distinct().groupBy(letters.alias("letters")).agg(
        F.array_join(F.array_sort(F.collect_list("word")), " ").alias("words"), F.count("*").alias("n")
    )


def palindrome_flag(text: str) -> Column:
    """Whether the letters and digits read the same from both ends, case aside."""
    plain = F.lower(F.regexp_replace(F.col(text).cast("string"), r"[^\p{L}\p{N}]", ""))
    return plain == F.reverse(plain)


def last_word_length(text: str) -> Column:
    """Length of the last word, trailing blanks aside."""
    return F.length(F.substring_index(F.rtrim(F.col(text)), " ", -1))


def find_substring(text: str, needle: str) -> Column:
    """Place of the first occurrence counted from 0, or -1."""
    return F.locate(needle, F.col(text)) - 1


def letter_counts(df: DataFrame, key: str, text: str, out: str) -> DataFrame:
    """How often each letter occurs in each text."""
    letters = df.select(key, F.explode(F.split(F.col(text), "")).alias("letter")).where("letter <> ''")
    return letters.groupBy(key, "letter").agg(F.count("*").alias(out))


def can_construct(notes: DataFrame, magazines: DataFrame, key: str) -> DataFrame:
    """Whether the letters of a note can be cut from the magazine with its key.

    Only magazines that a note asks for are split into letters.
    """
    magazines = magazines.join(notes.select(key).distinct(), key, "left_semi")
    need = letter_counts(notes, key, "note", "need")
    have = letter_counts(magazines, key, "magazine", "have")
    short = need.join(have, [key, "letter"], "left").where("have is null or have < need").select(key).distinct()
    both = notes.select(key).join(magazines.select(key), key, "left_semi")
    missing = short.withColumn("_short", F.lit(True))
    return both.join(missing, key, "left").select(key, F.col("_short").isNull().alias("ok"))


def prefix_lookup(vocabulary: DataFrame, queries: DataFrame) -> DataFrame:
    """For every query whether it is a word and whether some word starts with it.

    Words are cut only at lengths that a query has.
    """
    asked = queries.select("word").distinct()
    lengths = asked.select(F.length("word").alias("n")).distinct()
    lengths = lengths.agg(F.array_sort(F.collect_set("n"))).scalar()
    size = F.length("word")
    starts = F.transform(
        F.filter(F.col("_lengths"), lambda n: n <= size),
        lambda n: F.struct(F.substring(F.col("word"), F.lit(1), n).alias("word"), (n == size).alias("whole")),
    )
    cut = vocabulary.withColumn("_lengths", lengths)
    prefixes = cut.select(F.explode(starts).alias("p")).groupBy("p.word").agg(F.max("p.whole").alias("whole"))
    return asked.join(prefixes, "word", "left").select(
        "word", F.coalesce("whole", F.lit(False)).alias("is_word"), F.col("whole").isNotNull().alias("is_prefix")
    )
