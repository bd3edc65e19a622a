"""What the driver's entry file registers: the operators and the pipeline."""

from __future__ import annotations

from corpus_pipeline import ORACLE_SQL, run
from sigloom.llm import layout_queries, oracle, queries, text_queries

QUERIES = queries.QUERIES | layout_queries.QUERIES | text_queries.QUERIES | {"pipeline": run}
ORACLE = oracle.ORACLE | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
