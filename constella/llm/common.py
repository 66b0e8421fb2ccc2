"""Helpers shared by the text and vector operators of this folder."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from constella.session import materialize as cut
from constella.session import shared_dir

__all__ = ["cut", "shared_dir", "table", "importable", "id_crc", "sums_before", "ordered_shards",
           "connected_components", "running", "free"]

#: Blocks of the first histogram of keys
MAX_BLOCKS = 65_536
GROUP = 256
#: Parts of a node's neighbours
SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers that share this folder (one machine, or a mounted path) import the package from it;
    elsewhere ship it with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def free(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def id_crc(col: str | Column) -> Column:
    """crc32 of the id as decimal text; a null id counts as the empty text."""
    col = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def sums_before(df: DataFrame, at: str, weight: str, within: str | None = None) -> DataFrame:
    """Add ``_before``: the summed ``weight`` of the rows with a smaller ``at`` (a number, unique) and the same
    ``within``.  Runs of GROUP places are summed first, so no task's window holds all rows."""
    keys = [within] if within else []
    df = df.withColumn("_run", F.floor(F.col(at) / GROUP).cast("bigint"))
    order = lambda *by: Window.partitionBy(*by)
    runs = df.groupBy(*keys, "_run").agg(F.sum(weight).alias("_w_run"))
    before = order(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*keys, "_run", F.coalesce(F.sum("_w_run").over(before), F.lit(0)).alias("_base_run"))
    before = order(*keys, "_run").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum(weight).over(before), F.lit(0))
    return df.withColumn("_before", inner).join(runs, [*keys, "_run"]).withColumn(
        "_before", F.col("_before") + F.col("_base_run")).drop("_run", "_base_run")


def ordered_shards(df: DataFrame, key: str, weight: Column, target: int) -> DataFrame:
    """Add ``_shard``: consecutive ranges of the integer ``key`` whose summed ``weight`` is about ``target``.

    The bounds come from exact histograms, not from a sample, so the same rows always get the same shards.  The first
    has MAX_BLOCKS equal-width blocks of keys; each block heavier than the target is cut into blocks of its own, again
    and again until a block is light enough or one key wide.  So neither a few outlying keys nor a large table make a
    shard heavy: it passes the target by less than one block (or one key's rows).  Equal keys share a shard; null keys
    come first.  Shard numbers ascend with the key and may have gaps.
    """
    low, high = df.agg(F.min(key), F.max(key)).first()
    if low is None:
        return df.withColumn("_shard", F.lit(0).cast("bigint"))
    long = lambda x: F.lit(str(x)).cast("decimal(20,0)")
    wide = (F.col(key).cast("decimal(20,0)") - long(low)).cast("decimal(20,0)")
    width = (high - low) // MAX_BLOCKS + 1

    def place(base: Column) -> Column:    # number of the block within its parent, which begins at base
        at = wide - base
        return ((at - at % long(width)) / long(width)).cast("bigint")

    # a block is known by its begin; null keys have a block before all others, which is never cut
    begin = lambda base: (wide - (wide - base) % long(width)).cast("decimal(20,0)")
    rows = df.withColumn("_at", F.coalesce(begin(long(0)), long(-1)))
    inside = rows.withColumn("_of", long(0)).withColumn("_i", F.coalesce(place(long(0)), F.lit(-1)))
    base = df.sparkSession.range(1).select(long(0).alias("_of"), F.lit(0).cast("bigint").alias("_base"))
    light = None
    while True:
        cells = inside.groupBy("_of", "_i", "_at").agg(F.sum(weight).cast("bigint").alias("_w"))
        cells = sums_before(cells, "_i", "_w", "_of").join(base, "_of")
        cells = cut(cells.select("_at", "_w", (F.col("_base") + F.col("_before")).cast("bigint").alias("_base")), name="cells")
        heavy = cells.filter((F.col("_w") > target) & (F.col("_at") >= 0)) if width > 1 else cells.limit(0)
        many, load = heavy.agg(F.count("*"), F.sum("_w")).first()
        kept = cells if not many else cells.filter((F.col("_w") <= target) | (F.col("_at") < 0))
        light = kept if light is None else light.unionByName(kept)
        if not many:
            break
        width = -(-width // max(2, MAX_BLOCKS // many, -(-4 * load // (target * many))))
        base = heavy.select(F.col("_at").alias("_of"), "_base")
        rows = rows.join(base.select("_of"), F.col("_at") == F.col("_of"), "left")
        rows = rows.withColumn("_at", F.when(F.col("_of").isNull(), F.col("_at")).otherwise(begin(F.col("_of"))))
        inside = rows.filter("_of is not null").withColumn("_i", place(F.col("_of")))
        rows = rows.drop("_of")
    # a block is a few numbers, and their count is bounded: MAX_BLOCKS a round and a few for each target of weight; so
    # they are broadcast at any size, and the rows, which hold whole payloads, aren't shuffled to find their shard
    light = light.select(F.col("_at").alias("_cell"), F.floor(F.col("_base") / F.lit(target)).cast("bigint").alias("_shard"))
    return rows.join(F.broadcast(light), F.col("_at") == F.col("_cell")).drop("_at", "_cell")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (u, v); root is the smallest node of its component.

    Alternating large-star / small-star contraction: each round is two grouped minima and two joins back.  A node's
    neighbours are dealt to SALTS parts, of which it has only those that hold some; minima are taken in each part and
    then over its parts, and go back by (node, part), so a hub's links meet them in many tasks.  Rounds grow with the
    logarithm of the longest path.  Each round is cut to Parquet in the shared folder.
    """
    pairs = (edges.filter("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct())
    pairs = cut(pairs, name="components")
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.union(pairs.select("b", "a"))
        large = (_with_least(both).select("a", "b", F.least("a", "m").alias("m")).filter("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        small = _with_least(large).select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()
        pairs = cut(small, name="components")
        mark, last = _mark(pairs), mark
        if mark == last:
            break
    roots = pairs.groupBy("a").agg(F.min("b").alias("root"))
    return (roots.select(F.col("a").alias("node"), "root")
            .union(roots.select(F.col("root").alias("node"), "root").distinct()))


def _with_least(pairs: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``m``, the smallest b of its a."""
    pairs = pairs.withColumn("_salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    parts = pairs.groupBy("a", "_salt").agg(F.min("b").alias("m"))
    least = parts.groupBy("a").agg(F.min("m").alias("m"), F.collect_list("_salt").alias("_salts"))    # SALTS at most
    return pairs.join(least.select("a", "m", F.explode("_salts").alias("_salt")), ["a", "_salt"]).select("a", "b", "m")


def _mark(pairs: DataFrame) -> tuple:
    """Count and order-free hash of the rows, to see that a round changed nothing."""
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def running(df: DataFrame, group: str, order: list[Column], weight: Column | None = None,
            about: DataFrame | None = None) -> DataFrame:
    """Add ``_before``, the summed ``weight`` of the rows that go before a row in its ``group`` by ``order`` (its place
    from 0 where no weight is given), and ``_total``, the sum over the group; null is a group.  ``about`` (unique on
    ``group``) adds its columns.

    One range-partitioned sort by group and order, cut to Parquet, so a group of any size is spread over partitions.
    Sums of each (partition, group) carry over by a window over as many rows as a group has partitions; ``about``
    joins those sums, and rows meet them by (partition, group), never by a hot group alone.  Rows that tie in
    ``order`` may change places; make it total over the columns that matter.
    """
    ranked = df.withColumn("_w", F.lit(1) if weight is None else weight)
    ranked = ranked.orderBy(F.col(group).asc_nulls_first(), *order).withColumn("_rid", F.monotonically_increasing_id())
    ranked = cut(ranked.withColumn("_part", F.shiftright("_rid", 33)), name="running")
    sums = ranked.groupBy("_part", group).agg(F.sum("_w").alias("_sum"), F.min("_rid").alias("_first"))
    span = Window.partitionBy(group)
    sums = sums.select("*", F.sum("_sum").over(span).alias("_total"), F.coalesce(F.sum("_sum").over(
        span.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base")).drop("_sum")
    if about is not None:
        named = about.withColumnRenamed(group, "_about")
        sums = sums.join(named, F.col(group).eqNullSafe(F.col("_about")), "left").drop("_about")
    sums = sums.withColumnsRenamed({"_part": "_p", group: "_g"})
    found = ranked.join(sums, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))).drop("_p", "_g")
    if weight is None:
        found = found.withColumn("_before", F.col("_base") + F.col("_rid") - F.col("_first"))
    else:
        inner = Window.partitionBy("_part", group).orderBy("_rid").rowsBetween(Window.unboundedPreceding, -1)
        found = found.withColumn("_before", F.col("_base") + F.coalesce(F.sum("_w").over(inner), F.lit(0)))
    return found.drop("_w", "_rid", "_part", "_first", "_base")
