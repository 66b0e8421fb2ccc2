"""What a run reads of the history: no shuffle of it, only batches that can matter, few directories."""

import os
import re

from pyspark.sql import functions as F

from constella.operators import bridge_rows, new_fact_rows, one_row_per_key
from constella.operators.merge import absent_by_key
from constella.plans.pipeline import RunOptions, committed, run_batch
from constella.sources.state import batches_after, batches_with_ids, read_state
from constella.sources.tables import BUCKETED, SCHEMAS, Warehouse
from tests.helpers import movie, raw_df


def rows(spark, ids, day=None, slug=None):
    return raw_df(spark, [movie(i, slug=slug or f"s{i % 7}", date=f"2024-01-{day or i:02d} 00:00:00", language=f"l{i % 3}",
                                genres=["drama", f"g{i % 2}"], runtime=90, rating=7.0, year=2000) for i in ids])


def exchanges_over_scan(df, table):
    """Exchanges between the scan of ``table`` and the joins above it."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(re.match(r"(?:   |:  )*(?:[+:]- )?", line).group())
    found = []
    for i, line in enumerate(lines):
        if "FileScan" in line and table in line and "PushedFilters: [IsNull(" not in line:   # not the few without a key
            at = depth(line)
            for above in reversed(lines[:i]):
                if depth(above) < at:
                    at = depth(above)
                    if "Join" in above:
                        break
                    if "Exchange" in above:
                        found.append(above.strip())
    return found, sum("FileScan" in line and table in line and "PushedFilters: [IsNull(" not in line for line in lines)


def test_history_is_not_shuffled(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh", buckets=4).setup()
    for k in range(2):
        run_batch(wh, rows(spark, range(1 + 10 * k, 11 + 10 * k)))
    window = wh.read("cleaned_data", only=2)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fact, bridge, dim = (wh.read(n, upto=2) for n in ("fact_movies", "genre_junction", "dim_movie"))
        new = window.select("movie_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS["fact_movies"].fields[1:]])
        genres = wh.read("dim_genre", upto=2)
        plans = [(new_fact_rows(new, fact, probe=window, buckets=4), "fact_movies"),
                 (bridge_rows(window, "movie_id", "genres", genres, "genre_name", "genre_id", bridge, 4), "genre_junction"),
                 (absent_by_key(one_row_per_key(window, "slug", ["url"]), dim, "slug", 4), "dim_movie")]
        for df, table in plans:
            found, scans = exchanges_over_scan(df, table)
            assert scans and not found, (table, found)
            assert df.count() == 0                       # all loaded already
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = [f for f in os.listdir(f"{scratch}/wh/gold/fact_movies/batch_id=1") if f.startswith("part")]
    assert len(files) <= 4 and len({f.split("_")[1].split(".")[0] for f in files}) == len(files)   # a file a bucket


def test_null_ids_and_slugs_are_inserted_once(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh").setup()
    batch = raw_df(spark, [movie(None, slug="x", date="2024-01-01 00:00:00", genres=["drama"]),
                           movie(2, slug="m2", date="2024-01-01 00:00:00", genres=["drama"])]).withColumn(
        "slug", F.when(F.col("id").isNotNull(), F.col("slug")))
    for _ in range(3):
        run_batch(wh, batch)
    assert sorted(((r.movie_id, r.genre_id) for r in committed(wh, "genre_junction").collect()), key=repr) == [(2, 1), (None, 1)]
    assert sorted((r.slug or "") for r in committed(wh, "dim_movie").collect()) == ["", "m2"]


def test_zone_maps_leave_out_batches(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh").setup()
    for k in range(4):        # ids 1-5, 6-10, ...; days likewise
        run_batch(wh, rows(spark, range(1 + 5 * k, 6 + 5 * k)))
    bound = lambda text: F.lit(text).cast("timestamp_ntz")
    assert sorted(batches_after(wh, 5, bound("2024-01-12 00:00:00"))) == [3, 4]
    assert sorted(batches_with_ids(wh, 5, 8, 12, False)) == [2, 3]
    assert batches_with_ids(wh, 5, 100, 200, True) == [] == batches_with_ids(wh, 5, None, None, False)
    read = lambda df: {p.split("batch_id=")[1].split("/")[0] for p in df.inputFiles()}
    assert read(wh.read("cleaned_data", batches=[3, 4])) == {"3", "4"}
    # a lookback run with two late rows: the same as one that reads everything
    r = run_batch(wh, rows(spark, [21, 22], day=19), options=RunOptions(lookback="2 days"))
    assert r.window_rows == 4 and r.late_rows == 2            # 19 and 20 again
    assert sorted(x.movie_id for x in committed(wh, "fact_movies").collect()) == list(range(1, 23))


def test_compaction_keeps_rows_and_bounds_directories(spark, scratch):
    plain, wh = (Warehouse(spark, f"{scratch}/{n}").setup() for n in ("plain", "compacted"))
    live = []
    for k in range(4):
        batch = rows(spark, range(1 + 3 * k, 5 + 3 * k))
        run_batch(plain, batch)
        run_batch(wh, batch, options=RunOptions(compact_every=2))
        live.append(wh.last - wh.base + 1)
        dirs = [d for d in os.listdir(f"{scratch}/compacted/gold/dim_language") if d.startswith("batch_id=")]
        assert len(dirs) <= 3 and len(wh.batches()) <= 3
    assert max(live) <= 3
    for name in SCHEMAS:
        if name not in ("state", "run_log", "landed_pages"):
            got, want = (sorted(map(repr, committed(w, name).collect())) for w in (wh, plain))
            assert got == want, name
    log = committed(wh, "run_log").collect()
    assert sorted(r.source or "run" for r in log).count("run") >= 2 and len({r.run for r in log}) == len(log)
    # a new object, as a later driver has it, finds the live batches and the number of buckets
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        later = Warehouse(spark, f"{scratch}/compacted").setup()
        assert later.buckets == 8 and (later.base, later.last) == (wh.base, wh.last)
        run_batch(later, rows(spark, [25]))
        assert committed(later, "fact_movies").filter("movie_id = 25").count() == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert wh.compact() is not None and wh.compact() is None
    assert read_state(wh)["source"] == "compaction" and set(BUCKETED) <= set(SCHEMAS)


def test_reset_starts_over(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh").setup()
    run_batch(wh, rows(spark, [1, 2]))
    run_batch(wh, rows(spark, [3]))
    wh.reset()
    assert read_state(wh) is None and all(committed(wh, n).count() == 0 for n in SCHEMAS if n != "state")
    assert run_batch(wh, rows(spark, [9])).batch_id == 1
    assert [r.movie_id for r in committed(wh, "fact_movies").collect()] == [9]
