"""Composite plans: stand-ins over the driver tables, multi-batch plans,
the committed pipeline run and the registered queries."""
