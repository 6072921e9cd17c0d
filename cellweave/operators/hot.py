"""Keeping large groups apart: no group is gathered in one task beyond a bound, and no join key fills one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session

# A key is hot that has more than this share of the rows; there can be no more such keys than its inverse.
HOT_SHARE = 1 / 64
# Keys that the sketch tracks: each count is off by a few of their inverses of all rows at most.
TRACKED = 4096
# Places that the rows of a hot key are dealt to.
SALTS = 64


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Values of ``key`` that hold more than ``share`` of all rows, by a sketch of frequent items that tasks fill and merge.

    Every such value is found; one that is found may have a little less.
    """
    items, total = df.agg(F.expr(f"approx_top_k(`{key}`, {int(1 / share) + 1}, {TRACKED})"), F.count(key)).first()
    return [x["item"] for x in items or [] if x["item"] is not None and x["count"] > total * share]


def _salt(df: DataFrame) -> Column:
    """A place from 0 to SALTS for each row; the same one if a task runs again."""
    plain = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType | T.VariantType)]
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]) + F.spark_partition_id() * 7919, F.lit(SALTS)).cast("int")


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", row_bytes: int = session.ROW_BYTES) -> DataFrame:
    """Join of ``left`` with ``right`` by ``key`` where a few keys may hold most rows of ``left``.

    A right side that a count proves small is broadcast. Otherwise rows of hot keys are dealt to SALTS places and only these
    keys' rows of ``right`` are repeated for each; all others meet as usual. ``right`` is used twice: settle it if it is dear.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"No such join: {how}")
    small = session.broadcast_if_small(right, row_bytes)
    hot = [] if small is not right else hot_keys(left, key)
    if not hot:
        return left.join(small, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    dealt = left.withColumn("_salt", F.when(is_hot, _salt(left)).otherwise(0))
    repeated = right.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(repeated, [key, "_salt"], how).drop("_salt")


def split_groups(df: DataFrame, key: str, entry: list[str], limit: int, part: str = "part") -> DataFrame:
    """Add ``part`` so that (key, part) holds about ``limit`` rows at most; small groups are part 0.

    Sizes are counted with partial aggregation; only keys above the limit are joined back, and there are at
    most rows/limit of them. ``entry`` columns decide a row's part, so that a retried task decides the same.
    """
    large = df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > limit)
    large = session.settle(large.select(F.col(key), F.ceil(F.col("_n") / limit).alias("_parts")))
    joined = df.join(session.broadcast_if_small(large), key, "left")
    spread = F.pmod(F.xxhash64(*entry), F.col("_parts"))
    return joined.withColumn(part, F.coalesce(spread, F.lit(0)).cast("int")).drop("_parts")

