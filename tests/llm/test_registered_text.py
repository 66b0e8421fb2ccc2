"""Which of this folder's queries have a twin in SQL."""

import __spark_entry__ as entry
from constella.llm.queries import QUERIES

#: Operators and stages that SQL cannot express; their tests compare with brute force.
WITHOUT_SQL = {"op2_token_files", "op3_language", "op4_vectors", "op5_fingerprints", "op6_simhash", "op7_kneser_ney",
               "op8_surrogates", "op9_packing", "op10_bpe", "op11_whitening", "pipeline"}


def test_only_the_named_queries_lack_a_twin():
    assert set(entry.queries()) - set(entry.oracle_sql()) == WITHOUT_SQL
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
