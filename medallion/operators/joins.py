"""Equi-joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions.casting import soft_cast

SALT = "_salt"


def hot_shares(
    rows: DataFrame, key: str, share: float = 0.001, look_at: float = 0.01, seen_often: int = 100
) -> dict:
    """Keys that hold about ``share`` of the rows that have one, or more, with what share each holds; at most 1/share of them.

    A hint for :func:`spread_join`, which is right whatever it is given. So it may be
    cheap: it looks at a fraction ``look_at`` of one column, with a bounded sketch per
    task, and unique keys are never shuffled. A key seen less than ``seen_often`` times is
    not hot: a table that small needs no spreading.
    """
    known = rows.where(F.col(key).isNotNull())
    if look_at < 1:
        known = known.sample(look_at, seed=7)
    found = known.agg(
        F.count(F.lit(1)).alias("total"),
        F.expr(f"approx_top_k(`{key}`, {int(1 / share)}, {int(10 / share)})").alias("top"),
    ).first()
    least = max(share * found.total, seen_often)
    return {entry.item: entry["count"] / found.total for entry in found.top or [] if entry["count"] >= least}


def hot_keys(rows: DataFrame, key: str, share: float = 0.001, **options) -> list:
    """The keys of :func:`hot_shares` alone."""
    return list(hot_shares(rows, key, share, **options))


def salts_by_share(hot: dict, salts: int) -> dict[int, list]:
    """Over how many of ``salts`` tasks each hot key is dealt, as keys by that number.

    Twice the tasks that its share is worth, so that one task gets half a task's share of a hot key at most; at least
    two. The rows a hot key is joined with are repeated that often, so over all keys about twice ``salts`` times.
    """
    dealt: dict[int, list] = {}
    for key, share in hot.items():
        dealt.setdefault(min(salts, max(2, math.ceil(2 * share * salts))), []).append(key)
    return dealt


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str,
    hot: dict | list | None = None,
    salts: int | None = None,
    deal: Column | None = None,
) -> DataFrame:
    """``left.join(right, keys, how)`` for inner, left, left_semi and left_anti joins.

    Rows of ``left`` with a NULL key match nothing but would all hash to one task,
    and so would the rows of a hot key. The former are dealt over ``salts`` tasks (by default
    as many as a shuffle has), a hot key's over as many of them as its share asks for; the matching
    ``right`` rows of hot keys, and only those, are repeated that often.
    ``hot`` has values of the first key and their shares, see :func:`hot_shares`; values of a list are dealt over
    all ``salts``. ``deal`` is a hash
    that tells rows of one key apart; without it the salt is a seeded random number,
    which a retried task repeats only if ``left`` is read straight from files.
    """
    if salts is None:
        salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    dealt = salts_by_share(hot, salts) if isinstance(hot, dict) else {salts: hot} if hot else {}
    over = F.lit(1)
    for number, values in dealt.items():
        over = F.when(F.col(keys[0]).isin(values), F.lit(number)).otherwise(over)
    if deal is None:
        deal = F.floor(F.rand(7) * (1 << 31)).cast("int")
    salt = F.pmod(deal, F.when(no_key, F.lit(salts)).otherwise(over)).cast("int")
    salted = left.withColumn(SALT, F.when(no_key | (over > 1), salt).otherwise(F.lit(0)))
    known = right.where(~no_key)
    if dealt:
        known = known.withColumn(SALT, F.explode(F.sequence(F.lit(0), over - 1)))
    else:
        known = known.withColumn(SALT, F.lit(0))
    return salted.join(known, [*keys, SALT], how).drop(SALT)


def key_as(column: str, dtype: str) -> Column:
    """A join key cast to the other side's type; text that does not cast becomes NULL."""
    return soft_cast(F.col(column), dtype)
