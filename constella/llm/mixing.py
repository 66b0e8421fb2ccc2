"""Mixing sources to target weights by capped water-filling.

Every source asks for its weight's share of the words to mix.  Sources whose share passes ``epochs`` times their own
words are clamped there; what they leave goes to the others in proportion to their weights, until no source is above
its bound.  A source takes its documents as often as its target allows: whole repetitions of all of them, and one more
of the documents that come first in a seeded order, of the last of those only as many words as are left.

Spark functions only.  Edge cases: a null text counts no words; null is a source of its own and comes last; a source
without words has the target 0; rows with a null or repeated ``doc_id`` are documents of their own, placed by the
words they hold; an empty table gives an empty mix.  Other columns are not read, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from constella.llm.common import cut, running
from constella.operators.keys import dense_keys

WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ranked_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``sources`` (source, size) with ``weight``: by code point, null last, the numbers of ``cycle`` in turn."""
    ranked = dense_keys(sources, [F.col("source").asc_nulls_last()], "_rank")
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in cycle]), ((F.col("_rank") - 1) % len(cycle) + 1).cast("int"))
    return ranked.withColumn("weight", turn.cast("bigint")).drop("_rank")


def fill(sources: DataFrame, epochs: int = 3) -> DataFrame:
    """Add to ``sources`` (source, size, weight) their ``target`` and ``take``, the target to the nearest word.

    The level, words for each unit of weight, is a fraction of whole numbers, rest / open: what the clamped sources
    leave over the weights of the others.  A round clamps all sources above the level and spreads what they leave; the
    level only rises, so a clamped source stays clamped.  Rounds end when none is newly above; each is one aggregate
    over the sources, of which three numbers reach the driver."""
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    number = lambda v: F.lit(str(v)).cast("decimal(38,0)")
    cap = F.col("size") * epochs
    total, open_ = sources.agg(F.sum(exact("size")), F.sum(exact("weight"))).first()
    if not total:
        return sources.withColumns({"target": F.lit(0.0), "take": F.lit(0).cast("bigint")})
    rest, clamped = total, 0
    while True:
        above = cap.cast("decimal(28,0)") * number(open_).cast("decimal(28,0)") < (
            exact("weight").cast("decimal(18,0)") * number(rest).cast("decimal(20,0)"))
        n, left, weights = sources.agg(F.count(F.when(above, 1)), number(total) - F.coalesce(F.sum(
            F.when(above, cap.cast("decimal(38,0)"))), number(0)), F.sum(F.when(~above, exact("weight")))).first()
        if n == clamped:
            break
        rest, open_, clamped = left, weights, n
    share = exact("weight").cast("decimal(18,0)") * number(rest).cast("decimal(20,0)")
    target = F.when(above, cap.cast("double")).otherwise(share.cast("double") / number(open_).cast("double"))
    nearest = F.call_function("div", share * 2 + number(open_), number(open_ * 2))
    return sources.withColumns({"target": target, "take": F.when(above, cap).otherwise(nearest).cast("bigint")})


def mix(docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), epochs: int = 3, seed: int = 13) -> DataFrame:
    """doc_id, size, source_size, target, taken, source and repetitions (whole ones) of every row of ``docs``."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    sized = cut(docs.select("doc_id", "source", words().alias("size"), order.alias("_order")), name="sizes")
    sources = cut(sized.groupBy("source").agg(F.sum("size").alias("size")), name="sources")
    targets = fill(cut(ranked_weights(sources), name="weights"), epochs).select("source", "target", "take")
    # documents of a source in seeded order, laid end to end: those before the rest's end get one repetition more
    laid = running(sized, "source", [F.col("_order"), F.col("doc_id"), F.col("size")], F.col("size"), targets)
    whole = F.when(F.col("_total") > 0, F.expr("take div _total")).otherwise(0)
    extra = F.least(F.greatest(F.col("take") - F.col("whole") * F.col("_total") - F.col("_before"), F.lit(0)), F.col("size"))
    return laid.withColumn("whole", whole.cast("bigint")).select(
        "doc_id", "size", F.col("_total").cast("bigint").alias("source_size"), "target",
        (F.col("whole") * F.col("size") + extra).cast("bigint").alias("taken"), "source",
        F.col("whole").alias("repetitions"))
