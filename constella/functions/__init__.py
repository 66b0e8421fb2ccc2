"""Column expressions (all built-in Spark functions, codegen-friendly)."""

from constella.functions.dates import DATE_ATTRIBUTES, date_attributes, date_grain
from constella.functions.nested import default_array, first_element, parse_timestamp

__all__ = [
    "DATE_ATTRIBUTES", "date_attributes", "date_grain",
    "default_array", "first_element", "parse_timestamp",
]
