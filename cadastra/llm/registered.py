"""What ``__spark_entry__`` adds when this package is there."""

from __future__ import annotations

import corpus_pipeline
from cadastra.llm import queries

QUERIES = queries.QUERIES | {"pipeline": corpus_pipeline.run}
SQL = queries.SQL
