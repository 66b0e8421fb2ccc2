"""Sources and sinks: landed JSON pages, batch-partitioned Parquet tables, run state."""

from constella.sources.pages import (
    contiguous_mark,
    landed_movies,
    landed_prefix,
    page_plan,
    page_status,
    read_pages,
    unseen,
    total_pages,
    write_pages,
)
from constella.sources.literal import empty_table, literal_rows
from constella.sources.state import read_state, write_state
from constella.sources.tables import Warehouse

__all__ = [
    "Warehouse", "empty_table", "literal_rows", "contiguous_mark", "landed_movies", "landed_prefix", "page_plan",
    "page_status", "read_pages", "read_state", "total_pages", "unseen", "write_pages",
    "write_state",
]
