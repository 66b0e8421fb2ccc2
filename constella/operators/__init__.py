"""DataFrame operators of the incremental star-schema load."""

from constella.operators.bridge import bridge_rows
from constella.operators.clean import clean
from constella.operators.dims import (
    distinct_values,
    exploded_values,
    new_date_members,
    new_entity_members,
    new_members,
    one_row_per_key,
    with_sentinels,
)
from constella.operators.fact import Lookup, fact_rows, lookup_keys, new_fact_rows, one_row_per_id
from constella.operators.keys import dense_keys, key_offset
from constella.operators.merge import absent_from, insert_only
from constella.operators.window import advance_mark, incremental_window, incremental_window_sql, max_of

__all__ = [
    "Lookup", "absent_from", "advance_mark", "bridge_rows", "clean", "dense_keys",
    "distinct_values", "exploded_values", "fact_rows", "incremental_window", "incremental_window_sql", "insert_only",
    "key_offset", "lookup_keys", "max_of", "new_date_members", "new_entity_members",
    "new_fact_rows", "new_members", "one_row_per_id", "one_row_per_key",
    "with_sentinels",
]
