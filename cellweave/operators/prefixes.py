"""Short names (``prefix:local``) and full IRIs.

Prefixes are a dict (a configuration: looked up inside the row), a map column (the catalogue document's own)
or a DataFrame ``ordinal, prefix, namespace`` of any size (joined by equality).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import session
from .hot import skew_join

# What a prefix and its namespace take at most, where they are broadcast.
PREFIX_BYTES = 1024
# Behind every text that begins like it.
_BEHIND = "X'FF'"


def _has_prefix(name: Column) -> Column:
    return name.contains(":") & ~name.startswith("http")


def _prefix(name: Column) -> Column:
    return F.when(_has_prefix(name), F.substring_index(name, ":", 1))


def _after_colon(name: Column) -> Column:
    return F.substring(name, F.instr(name, ":") + 1, F.length(name))


def expand(name: Column, prefixes: dict[str, str] | Column) -> Column:
    """Full IRI of a short name; ``http...`` and unknown prefixes pass through."""
    if isinstance(prefixes, dict):
        if not prefixes:
            return name
        prefixes = F.create_map(*[F.lit(text) for pair in prefixes.items() for text in pair])
    namespace = F.try_element_at(prefixes, _prefix(name))
    return F.when(namespace.isNotNull(), F.concat(namespace, _after_colon(name))).otherwise(name)


def compact(iri: Column, prefixes: dict[str, str]) -> Column:
    """Short name by the first prefix, in the given order, whose namespace begins the IRI."""
    if not prefixes:
        return iri
    table = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(n).alias("n")) for p, n in prefixes.items()])
    first = F.get(F.filter(table, lambda entry: iri.startswith(entry["n"])), F.lit(0))
    rest = F.substring(iri, F.length(first["n"]) + 1, F.length(iri))
    return F.when(first.isNotNull(), F.concat(first["p"], F.lit(":"), rest)).otherwise(iri)


def expand_by_table(df: DataFrame, name: str, prefixes: DataFrame, out: str) -> DataFrame:
    """:func:`expand` with prefixes from a DataFrame; most names may share a prefix.

    Names without a prefix are joined by a text that no prefix has, each its own, so that they do not meet in
    one task.
    """
    table = session.settle(prefixes.select(F.col("prefix").alias("_prefix"), F.col("namespace").alias("_namespace")))
    key = F.coalesce(_prefix(F.col(name)), F.concat(F.lit("\n"), F.col(name)))
    joined = skew_join(df.withColumn("_prefix", key), table, "_prefix", "left", PREFIX_BYTES)
    full = F.when(
        F.col("_namespace").isNotNull(), F.concat(F.col("_namespace"), _after_colon(F.col(name)))
    ).otherwise(F.col(name))
    return joined.withColumn(out, full).drop("_prefix", "_namespace")


def _ranges(prefixes: DataFrame) -> DataFrame:
    """``key, prefix, cut``: disjoint ranges of IRIs, by where each begins, with the prefix that shortens them; null where none does.

    A namespace holds the texts between itself and the last one that begins with it. Inside that interval the prefix of lowest ordinal
    among its own and those of the namespaces around it wins; behind it, what wins around it.
    """
    own = prefixes.groupBy("namespace").agg(F.min(F.struct("ordinal", "prefix")).alias("first"))
    own = session.settle(own.select("namespace", "first.ordinal", "first.prefix", F.length("namespace").alias("size")))
    sizes = [r[0] for r in own.select("size").distinct().collect()]
    # namespaces around each one, itself among them: an equality at each length that namespaces have
    inner = own.select(F.col("namespace").alias("inside"), F.explode(F.filter(F.array(*map(F.lit, sizes)), lambda n: n <= F.col("size"))).alias("n"))
    cuts = inner.withColumn("namespace", F.expr("substring(inside, 1, n)")).join(own, "namespace")
    best = F.min(F.struct("ordinal", "prefix", "size"))
    around = F.min(F.when(F.col("namespace") != F.col("inside"), F.struct("ordinal", "prefix", "size")))
    winners = cuts.groupBy("inside").agg(best.alias("here"), around.alias("behind"))
    begins = winners.select(F.col("inside").cast("binary").alias("key"), F.lit(1).alias("order"), F.length("inside").alias("depth"), F.col("here").alias("win"))
    ends = winners.select(
        F.concat(F.col("inside").cast("binary"), F.expr(_BEHIND)).alias("key"), F.lit(0).alias("order"), -F.length("inside"), F.col("behind")
    )
    return begins.unionAll(ends)


def compact_by_table(df: DataFrame, iri: str, prefixes: DataFrame, out: str) -> DataFrame:
    """:func:`compact` with prefixes from a DataFrame; lowest ordinal wins.

    Namespaces become disjoint ranges of texts with their winning prefix. Ranges and rows are put in order of text together, by one
    range partitioning, and each row takes the last range that begins before it; what a partition lacks at its beginning comes from
    the partitions before, of which one row each is needed.
    """
    win = "struct<ordinal:int,prefix:string,size:int>"
    ranges = _ranges(prefixes).select("key", "order", "depth", F.col("win").cast(win).alias("win"), F.lit(None).cast(df.schema).alias("_row"))
    # a row comes behind the ranges that begin at its text
    rows = df.select(
        F.col(iri).cast("binary").alias("key"), F.lit(2).alias("order"), F.lit(0).alias("depth"), F.lit(None).cast(win).alias("win"), F.struct("*").alias("_row")
    )
    order = ["key", "order", "depth"]
    # rows of one text may fill a partition of their own or several
    placed = ranges.unionByName(rows).withColumn("_tie", F.monotonically_increasing_id())
    placed = session.settle(placed.repartitionByRange(*order, "_tie").withColumn("_part", F.spark_partition_id()))
    is_range = F.col("order") < 2
    told = F.when(is_range, F.struct("win"))
    last = placed.filter(is_range).groupBy("_part").agg(F.max_by("win", F.struct(*order)).alias("win"))
    # one row per partition goes through this window
    parts = placed.select("_part").distinct().join(last.withColumn("_told", F.struct("win")).drop("win"), "_part", "left")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("_part", F.last("_told", ignorenulls=True).over(before).alias("_carried"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = placed.withColumn("_told", F.last(told, ignorenulls=True).over(inside)).filter(F.col("order") == 2)
    best = F.coalesce("_told", "_carried")["win"]
    found = found.join(F.broadcast(carried), "_part").select("_row.*", best.alias("_best"))
    short = F.concat(F.col("_best.prefix"), F.lit(":"), F.substring(F.col(iri), F.col("_best.size") + 1, F.length(iri)))
    return found.withColumn(out, F.coalesce(short, F.col(iri))).drop("_best")
