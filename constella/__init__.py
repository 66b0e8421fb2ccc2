"""constella: incremental star-schema loading as plain Spark DataFrame operators.

Landed JSON pages -> cleaned silver rows -> dimension tables with stable
surrogate keys, a many-to-many bridge and an insert-only fact table, driven
in batch or by Structured Streaming with ``availableNow``.
"""

from constella.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
