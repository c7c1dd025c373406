"""Join per-key facts back to rows when one key may hold much of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ROWS = "_n"


def attach(df: DataFrame, stats: DataFrame, keys: list[str], rows: str = ROWS) -> DataFrame:
    """Inner join of rows with one row of facts per key.

    ``stats`` carries the row count of each key in ``rows``.  Keys above the
    mean partition size are at most as many as there are partitions, so their
    facts are broadcast and their rows never move; all other keys are joined
    by hash as usual.  Null keys match.
    """
    facts = [c for c in stats.columns if c not in keys and c != rows]
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    limit = stats.agg(F.sum(rows) / F.lit(parts)).scalar()
    named = stats.select(
        *[F.col(k).alias(f"_j_{k}") for k in keys], *[c for c in stats.columns if c not in keys]
    )
    on = [F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys]
    hot = F.broadcast(named.where(F.col(rows) > limit))
    cold = named.where(F.col(rows) <= limit)
    out = [*df.columns, *facts]
    heavy = df.join(hot, on).select(*out)
    light = df.join(hot, on, "left_anti").join(cold, on).select(*out)
    return heavy.unionAll(light)


def keys_of(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct keys for the right side of a semi or anti join.

    Copies of a key are dropped before the shuffle, so a key that fills much
    of the table does not gather in one task.
    """
    return df.select(*columns).distinct()


def keep_matching(df: DataFrame, stats: DataFrame, keys: list[str], rows: str = ROWS) -> DataFrame:
    """Rows whose key is in ``stats``."""
    return attach(df, stats.select(*keys, rows), keys, rows)
