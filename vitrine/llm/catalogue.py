"""The queries of this package and of the pipeline at the top of the repository."""

import corpus_pipeline
from vitrine.llm.queries import CHECKS, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    CHECKS["pipeline"] = corpus_pipeline.ORACLE_SQL
