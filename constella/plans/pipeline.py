"""One committed incremental run: landed movie rows -> bronze -> silver ->
genre dimension + bridge, movie, date, language, runtime, rating and year
dimensions -> fact -> state row (the commit).

Retry-safe: batch N reads every table with ``batch_id < N`` (its own earlier
attempt is invisible) and overwrites ``batch_id=N`` directories, so a crash
anywhere before the state row is repaired by running N again.  The date
window is pinned once per run; all steps see the same slice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constella.functions.dates import date_grain
from constella.operators import absent_from, clean, fact_rows, incremental_window, new_fact_rows, one_row_per_id
from constella.operators.window import as_bound
from constella.plans.batches import (
    DIM_STEPS,
    FACT_COLUMNS,
    FACT_DIMS,
    FACT_SOURCE,
    SENTINEL_YEARS,
    TS,
    bridge_step,
    date_step,
    fact_lookups,
    fact_step,
    movie_step,
    year_step,
)
from constella.plans.concurrent import run_all
from constella.session import materialize, scratch
from constella.sources.pages import (
    contiguous_mark,
    landed_prefix,
    movie_rows,
    movies_of,
    page_heads,
    page_plan,
    page_status,
    parse_text,
    read_pages,
    total_pages,
    unseen,
)
from constella.sources.state import batches_after, batches_with_ids, read_state, write_state
from constella.sources.tables import BATCH, Warehouse, columns_of

# Order of the gold steps within a run (the bridge needs the genre dimension
# of the same batch; the fact needs the six lookup dimensions).
DIM_ORDER = ["dim_genre", "dim_movie", "dim_date", "dim_language", "dim_runtime",
             "dim_rating", "dim_released_year"]


@dataclass(frozen=True)
class RunOptions:
    lookback: str | None = None          # re-admit rows up to this interval before the mark
    date_grain: str = "timestamp"        # or "day": one dim_date row per day
    sentinel_years: tuple = SENTINEL_YEARS
    empty_genres_as_default: bool = False
    strict_window: bool = False          # admit by the date mark instead of by batch
    parallelism: int = 8                 # concurrent dimension steps (1 = sequential)
    compact_every: int | None = None     # rewrite the live batches into one when there are more than this


@dataclass(frozen=True)
class RunResult:
    batch_id: int
    last_date: object
    window_rows: int
    null_date_rows: int
    late_rows: int = 0


def run_batch(wh: Warehouse, landed: DataFrame, batch_id: int | None = None,
              options: RunOptions = RunOptions(), last_page: int | None = None,
              source: str | None = None, pages: DataFrame | None = None) -> RunResult:
    """Load ``landed`` (raw movie rows, ``RAW_MOVIE`` columns) as batch
    ``batch_id`` (default: last committed + 1; the last committed one may be
    run again, older ones have successors and may not).

    The run's slice is the dated rows of its own batch: every load is
    insert-only, so a row that landed late is loaded like any other (and
    counted as ``late_rows``).  ``options.strict_window`` admits by the date
    mark alone instead.  ``pages`` are the ledger rows of the landed pages
    that the batch takes, committed with it."""
    newest = read_state(wh)
    n = (newest["batch_id"] if newest else 0) + 1 if batch_id is None else batch_id
    if newest and (n < newest["batch_id"] or n == newest["batch_id"] == newest["base"] and newest["source"] == "compaction"):
        raise ValueError(f"batch {n} has successors or is a compaction; only the last run can be run again")
    prev = newest if newest and newest["batch_id"] < n else read_state(wh, below=n)
    with scratch(wh.spark):
        result = _run(wh, landed, n, prev, options, last_page, source, pages)
    if options.compact_every and wh.last - wh.base >= options.compact_every:
        wh.compact()
        wh.vacuum()
    return result


def _run(wh: Warehouse, landed: DataFrame, n: int, prev, options: RunOptions, last_page: int | None,
         source: str | None, pages: DataFrame | None) -> RunResult:
    last = prev["last_date"] if prev else None
    prev_page = prev["last_page"] if prev else 0

    # bronze (raw copy of what landed) and silver for this batch
    if pages is not None:
        wh.write("landed_pages", pages, n)
    wh.write("raw_data", landed, n)
    wh.write("cleaned_data", clean(_batch(wh, "raw_data", n),
                                   empty_genres_as_default=options.empty_genres_as_default), n)

    # The window.  Every committed silver date is <= the committed mark, so
    # without a lookback only this batch's rows can qualify: read just its
    # partition; with one, also the batches whose dates reach into it.  The
    # upper bound is pinned once (one scalar to the driver).
    if options.lookback and last is not None:
        bound = as_bound(wh.read("cleaned_data", only=n), TS, last) - F.expr(f"INTERVAL {options.lookback}")
        silver = wh.read("cleaned_data", batches=[*batches_after(wh, n, bound), n], keep_batch=True)
        # nothing below the lookback can qualify
        silver = silver.filter(F.col(TS).isNull() & (F.col(BATCH) == n) | (F.col(TS) > _literal(silver, last, options.lookback)))
    else:
        silver = _batch(wh, "cleaned_data", n)
    # one aggregate gives the pinned upper bound, the run's counters and its zone map: all
    # rows with ts > lower are <= max(ts), so the window is exactly them
    by_date = last is not None and (options.strict_window or options.lookback)
    lower = F.col(TS) > _literal(silver, last, options.lookback) if by_date else F.col(TS).isNotNull()
    late = F.col(TS) <= as_bound(silver, TS, last) if last is not None else F.lit(False)
    own, taken = F.col(BATCH) == n, F.when(lower, F.col("movie_id"))
    stats = silver.agg(
        F.max(TS).alias("upper"),
        F.count(F.when(lower, 1)).alias("rows"),
        F.count(F.when(F.col(TS).isNull() & own, 1)).alias("null_dates"),
        F.count(F.when(late & own, 1)).alias("late"),
        F.min(F.when(own, F.col(TS))).alias("min_date"),
        F.max(F.when(own, F.col(TS))).alias("max_date"),
        F.min(taken).alias("min_id"),
        F.max(taken).alias("max_id"),
        F.count(F.when(lower & F.col("movie_id").isNull(), 1)).alias("null_ids"),
    ).first()
    upper, window_rows, null_dates = stats["upper"], stats["rows"], stats["null_dates"]
    window = incremental_window(silver, TS, last=last if by_date else None, upper=upper, lookback=options.lookback)
    if not by_date:
        window = window.filter(F.col(TS).isNotNull())
    # history of facts and pairs: only batches whose ids can meet the window's
    history = batches_with_ids(wh, n, stats["min_id"], stats["max_id"], stats["null_ids"] > 0)

    # dimensions: each reads its own table below N and writes batch N
    steps = dict(DIM_STEPS)
    steps["dim_date"] = (steps["dim_date"][0], lambda w, d: date_step(w, d, grain=options.date_grain))
    steps["dim_released_year"] = (steps["dim_released_year"][0],
                                  lambda w, d: year_step(w, d, options.sentinel_years))

    steps["dim_movie"] = (steps["dim_movie"][0], lambda w, d: movie_step(w, d, wh.buckets))

    def load(name: str):
        def go():
            _, step = steps[name]
            wh.write(name, step(window, wh.read(name, below=n)), n)
            if name == "dim_genre":
                wh.write("genre_junction",
                         bridge_step(window, wh.read("dim_genre", upto=n),
                                     wh.read("genre_junction", batches=history), wh.buckets), n)
        return go

    # independent tables: their jobs are submitted concurrently
    run_all({name: load(name) for name in DIM_ORDER}, options.parallelism)

    dims = {name: wh.read(name, upto=n) for name in FACT_DIMS}
    if options.date_grain == "day":
        window = window.withColumn("_day", date_grain(TS, "day"))
    wh.write("fact_movies", _fact(window, dims, wh.read("fact_movies", batches=history), options, wh.buckets), n)

    # commit: the state row, written last; an empty window keeps the mark
    new_last = max((x for x in (upper if window_rows else None, last) if x is not None), default=None)
    write_state(wh, n, new_last, last_page if last_page is not None else prev_page,
                window_rows, null_dates, stats["late"], source, stats.asDict())
    wh.attach()
    return RunResult(n, new_last, window_rows, null_dates, stats["late"])


def _literal(df: DataFrame, last, lookback: str | None):
    lo = as_bound(df, TS, last)
    return lo - F.expr(f"INTERVAL {lookback}") if lookback else lo


def _batch(wh: Warehouse, name: str, n: int) -> DataFrame:
    """Only partition ``batch_id = n`` (pruned scan), with its batch id."""
    return wh.read(name, only=n, keep_batch=True)


def _fact(window: DataFrame, dims, existing: DataFrame, options: RunOptions, buckets: int) -> DataFrame:
    if options.date_grain != "day":
        return fact_step(window, dims, existing, order_first=(BATCH,), buckets=buckets)
    src = one_row_per_id(window, "movie_id", [BATCH, *FACT_SOURCE, "_day"])
    return new_fact_rows(fact_rows(src, fact_lookups(dims, "_day"), FACT_COLUMNS, probe=window, buckets=buckets),
                         existing, probe=window, buckets=buckets)


def committed(wh: Warehouse, name: str) -> DataFrame:
    """Rows of ``name`` in committed batches only."""
    st = read_state(wh)
    return wh.read(name, upto=st["batch_id"] if st else 0)


def committed_sql(wh: Warehouse, name: str) -> DataFrame:
    """The same through the catalog table (``register_tables`` first), as SQL
    with named parameters for the live batches."""
    read_state(wh)
    return wh.spark.sql(f"SELECT * EXCEPT ({BATCH}) FROM IDENTIFIER(:t) WHERE {BATCH} BETWEEN :a AND :b",
                        args={"t": wh.table_name(name), "a": wh.base, "b": wh.last})


def load_pages(wh: Warehouse, parsed: DataFrame, limit: int, options: RunOptions = RunOptions(),
               prefix: bool = False, source: str | None = None) -> RunResult | None:
    """One batch from ``parsed`` pages (of ``read_pages`` or a stream's micro-batch; cut to a row per movie, so that
    the landed text is parsed once and read again in columns, and no page is held whole).

    Pages that the ledger doesn't hold are new: their rows are loaded, and the
    ledger gets a row for each, with the text of those that can't be read.
    None, and nothing is written, where no page is new and the page mark stays.
    ``prefix`` stops at the first missing or failed page, as the daily run does."""
    prev = read_state(wh)
    last_page = prev["last_page"] if prev else 0
    ledger = wh.read("landed_pages", upto=wh.last)
    rows = materialize(movie_rows(parsed), name="pages")
    parsed = page_heads(rows)
    fresh = materialize(unseen(parsed, ledger), name="fresh")
    ledger = ledger.filter((F.col("page") > last_page) | F.col("page").isNull())
    # what is known of the pages after the mark, from this landing and from earlier batches
    known = parsed.select("page", "movie_count", "n_movies", "failed").unionByName(
        ledger.select("page", "movie_count", "n_movies", (F.col("status") == "failed").alias("failed")))
    max_page = wh.spark.range(1).select(total_pages(known, limit)).first()[0] or 0
    upto = mark = None
    if max_page > last_page:
        outcome = page_status(page_plan(wh.spark, last_page, max_page), known, limit)
        mark, upto = outcome.select(contiguous_mark(outcome, last_page), landed_prefix(outcome, last_page)).first()
    mark = max(last_page, mark or 0)
    taken = fresh.filter(~F.col("failed"))
    if prefix:
        taken = taken.filter(F.col("page") <= (upto if upto is not None else last_page))
    new = taken.unionByName(fresh.filter("failed"))
    if mark == last_page and new.isEmpty():
        return None
    outcomes = F.when(F.col("failed"), "failed").when(F.col("n_movies") == 0, "empty").otherwise("landed")
    log = new.withColumn("status", outcomes).withColumn("raw", F.when(F.col("failed"), F.col("raw"))).withColumn(
        "n_movies", F.col("n_movies").cast("bigint"))
    return run_batch(wh, movies_of(rows, taken), options=options, last_page=mark, source=source,
                     pages=log.select(*columns_of("landed_pages")).distinct())


def run_landed(wh: Warehouse, landing: str, limit: int = 50, options: RunOptions = RunOptions(),
               multiline: bool = False) -> RunResult | None:
    """One run over a landing folder of page envelopes (the daily trigger).

    Pages after the committed page mark are planned from the newest
    ``movie_count``; nothing runs when no page is new.  The contiguous run of
    landed pages after the mark is loaded (up to the first missing or failed
    page); the new page mark stops before the first missing, failed or partly
    filled page, so a page that is landed again there is read again (the
    ledger keeps pages that are the same from being loaded twice).  In a
    folder partitioned by page, pages up to the mark aren't opened."""
    prev = read_state(wh)
    try:
        pages = read_pages(wh.spark, landing, multiline, after=prev["last_page"] if prev else 0)
    except AnalysisException as e:            # nothing has landed yet
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise
    with scratch(wh.spark):
        return load_pages(wh, pages, limit, options, prefix=True, source="landed")


def failed_pages(wh: Warehouse) -> DataFrame:
    """The quarantine: failed pages of the ledger that no replay has loaded since.  A file may hold several, and a
    replay's page may have got its number from the repaired text: file and text tell them apart."""
    ledger = committed(wh, "landed_pages")
    done = ledger.filter(F.col("status") == "replayed")
    return absent_from(ledger.filter(F.col("status") == "failed"), done, ["path", "length", "modified", "raw"])


def replay_failed(wh: Warehouse, repair=lambda raw: raw, options: RunOptions = RunOptions()) -> RunResult | None:
    """Parse the quarantined texts again after ``repair`` (a column function) and load those that can be read now, as
    one batch.  The rest stays in quarantine."""
    with scratch(wh.spark):
        rows = materialize(movie_rows(parse_text(failed_pages(wh), repair(F.col("raw")))), name="replayed")
        parsed = page_heads(rows).filter(~F.col("failed"))
        if parsed.isEmpty():
            return None
        log = parsed.withColumns({"status": F.lit("replayed"), "n_movies": F.col("n_movies").cast("bigint"),
                                  "raw": F.col("was")})
        return run_batch(wh, movies_of(rows, parsed), options=options, source="replay",
                         pages=log.select(*columns_of("landed_pages")).distinct())
