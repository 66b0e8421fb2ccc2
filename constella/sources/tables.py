"""Batch-partitioned Parquet tables: retry-safe appends without a table format.

Every table is a directory of ``batch_id=N`` sub-directories.  Batch N writes
``table/batch_id=N`` anew (a retry replaces exactly what a failed attempt
left, also when the retry has no rows).  The state row of batch N is written
last and is the commit; it names ``base``, the first live batch.  Readers see
``base <= batch_id <= last committed``.  A compaction is a batch like any
other whose rows are those of all live batches and which is its own base.

The tables are registered in the session's catalog, which holds their list of
partitions: a reader lists only the directories that it reads, and the tables
named in ``BUCKETED`` are bucketed, so a join on their key shuffles only the
side that is new.  A batch adds its partition to each table it writes, one
statement a table.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from constella import schemas as S
from constella.session import delete, file_system

LAYERS = {
    "raw_data": "bronze",
    "landed_pages": "bronze",
    "cleaned_data": "silver",
    **{name: "gold" for name in S.GOLD},
    "run_log": "state",
    "state": "state",
}
SCHEMAS = {"raw_data": S.RAW_MOVIE, "landed_pages": S.LANDED_PAGES, "cleaned_data": S.SILVER, **S.GOLD,
           "run_log": S.RUN_LOG, "state": S.STATE}
BATCH = "batch_id"
#: Tables that grow with history and the key that later batches join them on.
BUCKETED = {"fact_movies": "movie_id", "genre_junction": "movie_id", "dim_movie": "slug"}
#: Read by their own batch only, so never rewritten.
KEPT = ("raw_data",)


def with_batch(schema: StructType) -> StructType:
    if BATCH in schema.fieldNames():
        return schema
    return StructType(list(schema.fields) + [StructField(BATCH, LongType(), True)])


def columns_of(name: str) -> list[str]:
    return [f.name for f in SCHEMAS[name].fields if f.name != BATCH]


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    buckets: int | None = None           # of a new warehouse (default: spark.sql.shuffle.partitions)
    catalog_prefix: str | None = None    # set by register_tables()
    registered: bool = False
    base: int = field(default=1, init=False)     # live batches as of the last state read
    last: int = field(default=0, init=False)
    _tables: dict = field(default_factory=dict, init=False, repr=False)
    _known: dict = field(default_factory=dict, init=False, repr=False)
    _lock: threading.RLock = field(default_factory=threading.RLock, init=False, repr=False)
    _attached: bool = field(default=False, init=False, repr=False)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{LAYERS[name]}/{name}"

    def batch_path(self, name: str, batch_id: int) -> str:
        return f"{self.path(name)}/{BATCH}={int(batch_id)}"

    def setup(self) -> "Warehouse":
        """Idempotent: reads the state and registers every table."""
        self.attach()
        for name in SCHEMAS:
            if name != "state":
                self.table_name(name)
        return self

    def reset(self, names: list[str] | None = None) -> None:
        """Explicit reset (never part of setup): every batch of the tables is removed, the state's last."""
        for name in names or [n for n in SCHEMAS if n != "state"] + ["state"]:
            delete(self.spark, self.path(name))
            if name != "state":
                table = self.table_name(name)
                self._drop_partitions(name, self._known.get(name, ()))
                self.spark.catalog.refreshTable(table)
        if names is None:    # a stream that starts over must see its files again
            delete(self.spark, self.stream_checkpoint())
            self.base, self.last = 1, 0

    def stream_checkpoint(self) -> str:
        return f"{self.root.rstrip('/')}/_stream_checkpoint"

    # --- commit rows ---------------------------------------------------------

    def batches(self) -> list[int]:
        """Batch ids that have a state directory, newest first (one listing)."""
        fs, where = file_system(self.spark, self.path("state"))
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return sorted((int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}=")), reverse=True)

    def state_row(self, below: int | None = None) -> Row | None:
        """The newest commit row (of a batch below ``below``); reads one directory."""
        schema = StructType([f for f in S.STATE.fields if f.name != BATCH])
        for n in self.batches():
            if n > 0 and (below is None or n < below):
                row = self.spark.read.schema(schema).parquet(self.batch_path("state", n)).first()
                if row is not None:      # else an attempt that was lost before it committed
                    return Row(**{BATCH: n, **row.asDict()})
        return None

    def attach(self, row: Row | None = None) -> Row | None:
        """Take the live batches from the newest commit row and tell the catalog about those it doesn't know."""
        with self._lock:
            row = row or self.state_row()
            self._attached = True
            self.base, self.last = ((row["base"] or 1), row[BATCH]) if row else (1, 0)
            if row and row["buckets"]:
                self.buckets = row["buckets"]
            for name in list(self._tables):
                self._add_partitions(name, range(1 if name in KEPT else self.base, self.last + 1))
            return row

    # --- rows ------------------------------------------------------------------

    def read(self, name: str, upto: int | None = None, below: int | None = None, keep_batch: bool = False,
             only: int | None = None, batches: Iterable[int] | None = None) -> DataFrame:
        """Rows of ``name`` in live batches with ``batch_id <= upto`` and/or ``batch_id < below``, or exactly ``only``,
        or those of ``batches``.  Only the directories of these batches are listed."""
        if not self._attached:
            self.attach()
        df = self.spark.table(self.table_name(name))
        if batches is not None:
            df = df.filter(F.col(BATCH).isin([int(b) for b in batches]))
        elif only is not None:
            df = df.filter(F.col(BATCH) == only)
        elif name not in KEPT:
            df = df.filter(F.col(BATCH) >= self.base)
        if upto is not None:
            df = df.filter(F.col(BATCH) <= upto)
        if below is not None:
            df = df.filter(F.col(BATCH) < below)
        return df if keep_batch else df.drop(BATCH)

    def write(self, name: str, df: DataFrame, batch_id: int) -> None:
        """``df`` as batch ``batch_id`` of ``name``, in place of what an earlier attempt left."""
        rows, where = df.select(*columns_of(name)), self.batch_path(name, batch_id)
        if name in BUCKETED:     # the bucketed layout can be written through the table only
            table, key = self.table_name(name), BUCKETED[name]
            delete(self.spark, where)
            rows = rows.repartition(self.buckets, key)      # one file a bucket
            self.spark.sql(f"INSERT INTO {table} PARTITION ({BATCH}={int(batch_id)}) SELECT * FROM {{rows}}", rows=rows)
            self._known.setdefault(name, set()).add(int(batch_id))
            return
        rows.write.mode("overwrite").parquet(where)
        if name != "state":
            self._known.setdefault(name, set()).discard(int(batch_id))
            self._add_partitions(name, [int(batch_id)])

    def compact(self) -> int | None:
        """Rewrite all live batches of every table into one new batch, its own base; None where one is live already.
        The commit row carries the marks over and the zones of the whole.  Old directories stay for readers that
        planned with them; ``vacuum`` removes them."""
        from constella.sources.literal import literal_rows
        last = self.attach()
        if last is None or self.base == self.last:
            return None
        n, live = self.last + 1, self.commits()
        zones = live.agg(F.min("min_date"), F.max("max_date"), F.min("min_id"), F.max("max_id"),
                         F.sum("null_ids"), F.max(F.col("null_ids").isNull() & (F.col("window_rows") > 0))).first()
        for name in SCHEMAS:
            if name not in ("state", "run_log", *KEPT):
                self.write(name, self.read(name, upto=self.last), n)
        log = live.withColumnRenamed(BATCH, "run").select(*columns_of("run_log"))
        self.write("run_log", self.read("run_log", upto=self.last).unionByName(log), n)
        ids = (None, None, None) if zones[5] else zones[2:5]     # a batch without a zone: any id may be in it
        row = {**last.asDict(), BATCH: n, "base": n, "source": "compaction", "buckets": self.buckets, "min_date": zones[0],
               "max_date": zones[1], "min_id": ids[0], "max_id": ids[1], "null_ids": ids[2]}
        self.write("state", literal_rows(self.spark, S.STATE, [tuple(row[f.name] for f in S.STATE.fields)]), n)
        self.attach()
        return n

    def vacuum(self) -> None:
        """Remove the directories of batches that a compaction has rewritten."""
        self.attach()
        old = [b for b in self.batches() if b < self.base]
        for name in SCHEMAS:
            if name not in KEPT:
                if name != "state":
                    self.table_name(name)
                    self._drop_partitions(name, old)
                for b in old:
                    delete(self.spark, self.batch_path(name, b))

    def commits(self) -> DataFrame:
        """The commit rows of the live batches."""
        live = [b for b in self.batches() if self.base <= b <= self.last]
        read = self.spark.read.schema(with_batch(S.STATE)).option("basePath", self.path("state"))
        return read.parquet(*[self.batch_path("state", b) for b in live])

    # --- catalog (namespaces + external partitioned tables) ------------------

    def table_name(self, name: str) -> str:
        """The catalog's name of a table; registered on first use."""
        with self._lock:
            if name not in self._tables:
                if not self._attached:
                    self.attach()
                if self.buckets is None:
                    self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
                place = hashlib.md5(f"{self.root.rstrip('/')} {self.buckets}".encode()).hexdigest()[:12]
                self._register(name, f"default.constella_{place}_{name}")
            return self._tables[name]

    def _register(self, name: str, table: str) -> None:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in with_batch(SCHEMAS[name]).fields)
        clustered = f"CLUSTERED BY ({BUCKETED[name]}) INTO {self.buckets} BUCKETS " if name in BUCKETED else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet "
                       f"PARTITIONED BY ({BATCH}) {clustered}LOCATION '{self.path(name)}'")
        self._tables[name] = table
        self._known[name] = set()
        self._add_partitions(name, range(1 if name in KEPT else self.base, self.last + 1))

    def _add_partitions(self, name: str, batches: Iterable[int]) -> None:
        new = [b for b in batches if b not in self._known.setdefault(name, set())]
        if new:
            parts = " ".join(f"PARTITION ({BATCH}={b})" for b in new)
            self.spark.sql(f"ALTER TABLE {self.table_name(name)} ADD IF NOT EXISTS {parts}")
            self._known[name].update(new)

    def _drop_partitions(self, name: str, batches: Iterable[int]) -> None:
        batches = list(batches)
        if batches:
            parts = ", ".join(f"PARTITION ({BATCH}={b})" for b in batches)
            self.spark.sql(f"ALTER TABLE {self._tables[name]} DROP IF EXISTS {parts}")
            self._known[name].difference_update(batches)

    def register_tables(self, prefix: str = "") -> "Warehouse":
        """Tables under names of one's own: ``CREATE DATABASE IF NOT EXISTS`` per layer and ``CREATE TABLE IF NOT
        EXISTS`` per table (external: dropping keeps the files).  Idempotent."""
        self.attach()
        self.catalog_prefix, self.registered = prefix or None, True
        if self.buckets is None:
            self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        for layer in sorted(set(LAYERS.values())):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}_{layer}" if prefix else f"CREATE DATABASE IF NOT EXISTS {layer}")
        for name in SCHEMAS:
            if name != "state":
                self._register(name, f"{prefix}_{LAYERS[name]}.{name}" if prefix else f"{LAYERS[name]}.{name}")
        return self

    def drop_tables(self, names: list[str] | None = None) -> None:
        """``DROP TABLE IF EXISTS`` (metadata only; the Parquet files stay, and reading registers them again under an
        internal name)."""
        for name in names or [n for n in SCHEMAS if LAYERS[n] in ("silver", "gold")]:
            if table := self._tables.pop(name, None):
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
