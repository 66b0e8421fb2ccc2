"""Document fingerprints as invertible Bloom lookup tables, with DataFrame functions only.

A text's paragraphs (lines that aren't blank, trimmed) are hashed to 64-bit digests; the distinct digests go into a
table of CELLS cells, each digest into one cell of each third.  A cell holds how many digests it has, their xor and
the xor of their check hashes.  Subtracting two tables cell by cell cancels what both texts have; peeling takes the
digest of every cell that holds exactly one, removes it from its other cells, and goes on: what it takes are the
digests that only one of the two texts has (``differences`` returns them), and their likeness (Jaccard) follows.

Where peeling gets stuck the tables were too small for the difference: such pairs are tried again with a larger table
and another salt, made of independent parts of CELLS cells each to which the digests are dealt by hash, four times as
many parts at every attempt.  A part is a row of its own, so no array grows with a document.

Nulls and ties: a null text is the empty text; two texts without paragraphs have likeness 1.  Documents are ordered by
id, null ids first, then by text; the last is followed by the first, a single one by itself.  Repeated rows are
returned as often as they come.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from constella.llm.common import cut, ordered_shards

THIRD = 16
CELLS = 3 * THIRD
ROUNDS = 24


def paragraphs(text: Column) -> Column:
    """Distinct digests of a text's paragraphs."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))


def _cell(n: Column, key: Column, check: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), key.alias("key"), check.alias("check"))


def _zero() -> Column:
    return _cell(F.lit(0), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))


def _plus(a: Column, b: Column) -> Column:
    return _cell(a["n"] + b["n"], a["key"].bitwiseXOR(b["key"]), a["check"].bitwiseXOR(b["check"]))


def _places(third: int) -> Column:
    """What the check hashes of the digests in each cell of a third have in the bits that choose it."""
    return F.array(*[F.lit(c << 8 * third).cast("bigint") for c in range(THIRD)])


def _holds(x: Column, third: int, place: Column) -> Column:
    """Whether a digest, by its check hash, belongs in a cell."""
    return x["check"].bitwiseAND(F.lit(THIRD - 1 << 8 * third).cast("bigint")) == place


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once: within a lambda it would be for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _entry(key: Column, n: Column, salt: Column) -> Column:
    return _cell(n, key, F.xxhash64(key, salt))


def table_of(entries: Column) -> Column:
    """The cells for an array of entries (n, key, check)."""
    return _let(entries, lambda xs: F.concat(*[F.transform(_places(third), lambda place: F.aggregate(
        xs, _zero(), lambda held, x: F.when(_holds(x, third, place), _plus(held, x)).otherwise(held)))
        for third in range(3)]))


def sketch(digests: Column, salt: int = 0) -> Column:
    return table_of(F.transform(digests, lambda h: _entry(h, F.lit(1), F.lit(salt))))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _cell(
        x["n"] - y["n"], x["key"].bitwiseXOR(y["key"]), x["check"].bitwiseXOR(y["check"])))


def peel(cells: Column, salt: Column) -> Column:
    """The digests that differ, as structs (n: 1 for the first text's, -1 for the second's; key), or null if the table
    is too small to tell."""
    def without(cells: Column, pure: Column) -> Column:
        return F.concat(*[F.zip_with(F.slice(cells, THIRD * third + 1, THIRD), _places(third), lambda c, place: F.aggregate(
            pure, c, lambda held, x: F.when(_holds(x, third, place), _cell(
                held["n"] - x["n"], held["key"].bitwiseXOR(x["key"]), held["check"].bitwiseXOR(x["check"])))
            .otherwise(held))) for third in range(3)])

    def state_(cells: Column, found: Column, more: Column) -> Column:
        return F.struct(cells.alias("cells"), found.alias("found"), more.alias("more"))

    def round_(state: Column, _: Column) -> Column:
        single = F.array_distinct(F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (
            F.xxhash64(c["key"], salt) == c["check"])))
        return F.when(~state["more"], state).otherwise(_let(single, lambda pure: F.when(
            F.size(pure) == 0, state_(state["cells"], state["found"], F.lit(False))).otherwise(state_(
                without(state["cells"], pure), F.concat(state["found"], pure), F.lit(True)))))

    empty = lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0)
    none = F.array().cast("array<struct<n:int,key:bigint,check:bigint>>")
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), state_(cells, none, F.lit(True)), round_,
        lambda s: F.when(F.forall(s["cells"], empty), F.transform(
            s["found"], lambda c: F.struct(c["n"].alias("n"), c["key"].alias("key")))))


def written(cells: Column) -> Column:
    """A table as text: for each cell its count, xor and check in hexadecimal."""
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(
        ".", F.hex(c["n"].cast("bigint")), F.hex(c["key"]), F.hex(c["check"]))), "-")


def differences(pairs: DataFrame, row: str = "row", a: str = "a", b: str = "b") -> DataFrame:
    """(row, only_a, only_b): the digests of the arrays ``a`` and ``b`` of each row (its id is unique) that the other
    one lacks, as recovered by peeling."""
    pairs = pairs.select(F.col(row).alias("row"), F.col(a).alias("a"), F.col(b).alias("b"))
    first = pairs.select("row", peel(subtract(sketch(F.col("a")), sketch(F.col("b"))), F.lit(0)).alias("d"))
    first = cut(first, name="peeled")
    done = first.filter("d is not null")
    failed = first.filter("d is null").select("row")
    attempt = 0
    while not failed.isEmpty():
        attempt += 1
        salt = F.lit(attempt)
        parts = F.expr(f"cast((size(a) + size(b)) div 256 + 1 as bigint) * {4 ** attempt}")
        dealt = pairs.join(failed, "row", "left_semi").select("row", parts.alias("parts"), F.explode(F.concat(
            F.transform("a", lambda h: F.struct(h.alias("h"), F.lit(1).alias("n"))),
            F.transform("b", lambda h: F.struct(h.alias("h"), F.lit(-1).alias("n"))))).alias("x"))
        larger = dealt.groupBy("row", F.pmod(F.xxhash64("x.h", F.lit(-attempt)), F.col("parts")).alias("part")).agg(
            F.collect_list("x").alias("xs"))
        entries = F.transform("xs", lambda x: _entry(x["h"], x["n"], salt))
        tried = larger.select("row", peel(table_of(entries), salt).alias("d"))
        # what a row's parts give is no longer than its two arrays
        tried = cut(tried.groupBy("row").agg(F.when(F.count("*") == F.count("d"), F.flatten(F.collect_list("d"))).alias("d")),
                    name="peeled")
        done = done.union(tried.filter("d is not null"))
        failed = tried.filter("d is null").select("row")
    side = lambda n: F.transform(F.filter("d", lambda x: x["n"] == n), lambda x: x["key"])
    return done.select("row", side(1).alias("only_a"), side(-1).alias("only_b"))


def likeness(a: Column, b: Column, d: Column) -> Column:
    """Jaccard likeness of two sets of sizes a and b whose difference has size d."""
    return F.when(a + b == 0, F.lit(1.0)).otherwise((a + b - d) / (a + b + d))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_bytes: int = 2 << 20) -> DataFrame:
    """(key, text, digests, next_text, next_digests): each document with the one that follows it."""
    rows = docs.select(F.col(key).cast("bigint").alias(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = ordered_shards(rows, key, F.octet_length("text") + 64, shard_bytes)
    # the first document of the following shard, for the last of each
    place = F.struct(F.col(key).isNotNull().alias("x"), F.col(key).alias("k"))
    lowest = rows.groupBy("_shard").agg(F.min(place).alias("low")).withColumn("_run", F.shiftright("_shard", 10))
    within, around = Window.partitionBy("_run").orderBy("_shard"), Window.orderBy("_run")
    runs = lowest.groupBy("_run").agg(F.max("_shard").alias("_top"))
    runs = runs.select("_run", F.coalesce(F.lag("_top").over(around), F.max("_top").over(around.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))).alias("_earlier"))
    lowest = lowest.withColumn("_lag", F.lag("_shard").over(within)).join(runs, "_run")
    lowest = cut(lowest.select(F.col("_shard").alias("_of"), "low", F.coalesce("_lag", "_earlier").alias("_before")), name="lowest")
    firsts = rows.join(lowest, (rows["_shard"] == lowest["_of"]) & rows[key].eqNullSafe(F.col("low.k")))
    firsts = firsts.groupBy("_before").agg(F.min("text").alias("_first")).select(
        F.col("_before").alias("_shard"), "_first")
    order = Window.partitionBy("_shard").orderBy(F.asc_nulls_first(key), "text")
    rows = rows.withColumn("digests", paragraphs(F.col("text")))
    rows = rows.withColumn("_n", F.lead("text").over(order)).withColumn("_d", F.lead("digests").over(order))
    rows = rows.join(firsts, "_shard", "left")
    return rows.select(key, "text", "digests", F.coalesce("_n", "_first").alias("next_text"),
                       F.coalesce("_d", paragraphs(F.col("_first"))).alias("next_digests"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint beside those of an edited version and of the next document; ``lost`` and ``gained``
    are the recovered digests of the paragraphs that only the document and only its edited version have."""
    rows = with_next(docs, key, text).withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(
        F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr("next_text", F.lit(1), half)))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), key, "n_chars",
                       F.sha2("edited", 256).alias("edited_sha256"), "digests",
                       paragraphs(F.col("edited")).alias("edited_digests"), "next_digests")
    rows = cut(rows, name="digests")    # without texts; what follows needs only digests
    both = rows.select(F.expr("row * 2").alias("row"), F.col("digests").alias("a"), F.col("edited_digests").alias("b")).union(
        rows.select(F.expr("row * 2 + 1"), "digests", "next_digests"))
    found = differences(both).select(F.expr("row div 2").alias("row"), F.expr("row % 2").alias("of"), "only_a", "only_b")
    edited, following = F.col("of") == 0, F.col("of") == 1
    found = found.groupBy("row").agg(
        F.first(F.when(edited, F.col("only_a")), ignorenulls=True).alias("lost"),
        F.first(F.when(edited, F.col("only_b")), ignorenulls=True).alias("gained"),
        F.max(F.when(following, F.size("only_a") + F.size("only_b"))).alias("d_next"))
    return rows.join(found, "row").select(
        key, "n_chars", "edited_sha256", written(sketch(F.col("digests"))).alias("fingerprint"),
        written(sketch(F.col("edited_digests"))).alias("edited_fingerprint"),
        likeness(F.size("digests"), F.size("edited_digests"), F.size("lost") + F.size("gained")).alias("near_edited"),
        likeness(F.size("digests"), F.size("next_digests"), F.col("d_next")).alias("near_next"),
        F.array_sort("lost").alias("lost"), F.array_sort("gained").alias("gained"))
