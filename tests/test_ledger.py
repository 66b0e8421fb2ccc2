"""Each landed page is loaded once, whoever reads it and whatever is lost in between."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from constella.plans.pipeline import RunOptions, committed, failed_pages, replay_failed, run_batch, run_landed
from constella.plans.run_queries import land_standin
from constella.session import shared_dir
from constella.sources.pages import read_pages, write_pages
from constella.sources.state import read_state
from constella.sources.tables import Warehouse
from constella.streaming import run_stream
from tests.conftest import SF_SMALL
from tests.helpers import movie, raw_df


def land(spark, folder, ids, run, count=12, size=3):
    rows = raw_df(spark, [movie(i, date=f"2024-01-{i:02d} 00:00:00", language="en") for i in ids])
    rows = rows.withColumn("page", ((F.col("id") - 1) / size).cast("long") + 1)
    write_pages(rows, folder, "page", F.lit(count).cast("long"), size, run=run)


def put(folder, run, page, text):
    os.makedirs(f"{folder}/run={run}/page={page}", exist_ok=True)
    with open(f"{folder}/run={run}/page={page}/p.json", "w") as fh:
        fh.write(text)


def ids(wh, name="fact_movies", column="movie_id"):
    return sorted(r[0] for r in committed(wh, name).select(column).collect())


def test_stream_without_its_checkpoint_loads_nothing_twice(spark, scratch):
    landing = land_standin(spark, SF_SMALL, one_dir_per_page=True)
    wh = Warehouse(spark, f"{scratch}/wh").setup()
    run_stream(wh, landing, max_files_per_trigger=16)
    before = [sorted(map(tuple, wh.read(t, only=b).collect()), key=repr) for b in wh.batches() for t in ("fact_movies", "raw_data")]
    assert len(wh.batches()) == 2
    shutil.rmtree(wh.stream_checkpoint())
    run_stream(wh, landing, max_files_per_trigger=20)
    run_landed(wh, landing)
    run_stream(wh, landing, checkpoint=f"{scratch}/other")
    after = [sorted(map(tuple, wh.read(t, only=b).collect()), key=repr) for b in (2, 1) for t in ("fact_movies", "raw_data")]
    assert after == before and len(wh.batches()) == 2        # no batch written or written over
    found = ids(wh)
    assert len(found) == len(set(found)) == 1489


def test_runs_agree_on_what_is_new(spark, scratch):
    landing = f"{scratch}/landing"
    land(spark, landing, range(1, 7), "1")
    wh = Warehouse(spark, f"{scratch}/wh").setup()
    assert run_landed(wh, landing, limit=3).batch_id == 1 and ids(wh) == list(range(1, 7))
    run_stream(wh, landing, limit=3)                          # the daily run's pages aren't new to a stream
    assert read_state(wh)["batch_id"] == 1
    land(spark, landing, range(7, 13), "2")
    run_stream(wh, landing, limit=3)
    assert read_state(wh)["batch_id"] == 2 and read_state(wh)["last_page"] == 4
    assert run_landed(wh, landing, limit=3) is None           # nor the stream's to the daily run
    assert ids(wh) == list(range(1, 13)) == ids(wh, "raw_data", "id")


def test_a_page_landed_again_is_read_again(spark, scratch):
    landing = f"{scratch}/landing"
    land(spark, landing, [1, 2, 3, 4], "1", count=5)          # page 2 partly filled
    wh = Warehouse(spark, f"{scratch}/wh").setup()
    run_landed(wh, landing, limit=3)
    assert read_state(wh)["last_page"] == 1 and ids(wh) == [1, 2, 3, 4]
    assert run_landed(wh, landing, limit=3) is None           # the open page is as it was
    land(spark, landing, [4, 5], "2", count=6)
    run_landed(wh, landing, limit=3)
    assert ids(wh) == [1, 2, 3, 4, 5] and read_state(wh)["batch_id"] == 2


def test_crash_before_the_commit_leaves_the_pages_new(spark, scratch, monkeypatch):
    landing = f"{scratch}/landing"
    land(spark, landing, range(1, 7), "1", count=6)
    wh = Warehouse(spark, f"{scratch}/wh").setup()
    original = Warehouse.write

    def failing(self, name, df, b):
        if name == "state":
            raise RuntimeError("driver lost")
        return original(self, name, df, b)

    monkeypatch.setattr(Warehouse, "write", failing)
    with pytest.raises(RuntimeError):
        run_landed(wh, landing, limit=3)
    monkeypatch.setattr(Warehouse, "write", original)
    assert committed(wh, "landed_pages").count() == 0 and ids(wh) == []
    other = Warehouse(spark, f"{scratch}/wh").setup()          # as a new driver would
    assert run_landed(other, landing, limit=3).batch_id == 1 and ids(other) == list(range(1, 7))


def test_unreadable_pages_are_kept_and_replayed(spark, scratch):
    landing = f"{scratch}/landing"
    land(spark, landing, [1, 2, 3, 7, 8, 9], "1")
    broken = '{"data": {"movie_count": 12, "movies": [{"id": 4, "slug": "m4", "date_uploaded": "2024-01-04 00:00:00", "rating": "bad"}'
    put(landing, "1", 2, broken)
    put(landing, "1", 4, "no page at all")
    streamed = Warehouse(spark, f"{scratch}/streamed").setup()
    run_stream(streamed, landing, limit=3)
    assert ids(streamed) == [1, 2, 3, 7, 8, 9]                 # goes on after a failed page
    assert read_state(streamed)["last_page"] == 1              # which keeps the mark
    assert {(r.page, r.raw) for r in failed_pages(streamed).collect()} == {(2, broken), (4, "no page at all")}
    assert replay_failed(streamed) is None                     # still unreadable: nothing is written
    assert replay_failed(streamed, repair=lambda raw: F.concat(raw, F.lit("]}}"))).batch_id == 2
    assert ids(streamed) == [1, 2, 3, 4, 7, 8, 9]
    assert [r.page for r in failed_pages(streamed).collect()] == [4]
    assert replay_failed(streamed, repair=lambda raw: F.concat(raw, F.lit("]}}"))) is None

    daily = Warehouse(spark, f"{scratch}/daily").setup()
    run_landed(daily, landing, limit=3)
    assert ids(daily) == [1, 2, 3]                              # the daily run stops at it
    assert sorted(r.page for r in failed_pages(daily).collect()) == [2, 4]
    assert run_landed(daily, landing, limit=3) is None
    land(spark, landing, [4, 5, 6], "2")
    put(landing, "2", 4, '{"data": {"movie_count": 12, "movies": []}}')
    run_landed(daily, landing, limit=3)
    assert ids(daily) == list(range(1, 10))
    status = {r.page: r.status for r in committed(daily, "landed_pages").filter("status <> 'failed'").collect()}
    assert status == {1: "landed", 2: "landed", 3: "landed", 4: "empty"}


def test_landing_folder_is_pruned_by_the_page_mark(spark, scratch):
    landing = f"{scratch}/landing"
    for run, pages in [("1", range(1, 7)), ("2", range(7, 13))]:
        land(spark, landing, pages, run)
    pages = read_pages(spark, landing, after=2)
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((page" in plan.replace("\n", "")
    assert sorted(r.page for r in pages.collect()) == [3, 4]
    # the files of older pages may even be gone bad
    for f in glob.glob(f"{landing}/run=1/page=*/*.json"):
        with open(f, "w") as fh:
            fh.write("{")
    assert not [r for r in read_pages(spark, landing, after=2).collect() if r.failed]


def test_json_lines_files_are_known_page_by_page(spark, scratch):
    landing = f"{scratch}/landing"
    rows = raw_df(spark, [movie(i, date=f"2024-01-{i:02d} 00:00:00") for i in (1, 2, 3, 7, 8, 9)])     # page 2 is missing
    rows = rows.withColumn("page", ((F.col("id") - 1) / 3).cast("long") + 1)
    write_pages(rows.coalesce(1), landing, "page", F.lit(9).cast("long"), 3)
    wh = Warehouse(spark, f"{scratch}/wh").setup()
    run_landed(wh, landing, limit=3)
    assert ids(wh) == [1, 2, 3]                                # page 3 waits, though its file was read
    rows = raw_df(spark, [movie(i, date=f"2024-01-{i:02d} 00:00:00") for i in (4, 5, 6)]).withColumn("page", F.lit(2).cast("long"))
    write_pages(rows, f"{scratch}/more", "page", F.lit(9).cast("long"), 3)
    for f in glob.glob(f"{scratch}/more/*.json"):
        shutil.copy(f, landing)
    run_landed(wh, landing, limit=3)
    assert ids(wh) == list(range(1, 10)) and read_state(wh)["last_page"] == 3


def test_only_the_last_batch_may_be_run_again(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh").setup()
    for i in (1, 2):
        run_batch(wh, raw_df(spark, [movie(i, date="2024-01-01 00:00:00")]))
    with pytest.raises(ValueError):
        run_batch(wh, raw_df(spark, [movie(3, date="2024-01-01 00:00:00")]), batch_id=1)
    run_batch(wh, raw_df(spark, [movie(5, date="2024-01-01 00:00:00")]), batch_id=2)
    assert ids(wh) == [1, 5]


def test_runs_leave_no_scratch_behind(spark, scratch):
    root = os.path.dirname(shared_dir(spark, "x").replace("file:", ""))
    wh = Warehouse(spark, f"{scratch}/wh").setup()
    landing = f"{scratch}/landing"
    land(spark, landing, range(1, 7), "1", count=6)
    before = set(os.listdir(root))
    run_landed(wh, landing, limit=3, options=RunOptions(lookback="1 day"))
    run_stream(wh, landing, limit=3)
    assert set(os.listdir(root)) == before
