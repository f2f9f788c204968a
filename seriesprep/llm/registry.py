"""Imports every operator module, so that its queries are registered."""

import corpus_pipeline
from seriesprep.llm import byte_bpe, exact_dedup, html_extract, jaccard_join, line_dedup, minhash_dedup, mixing, pivot_search, spelling_variants, suffix_tree_lm, token_alignment, token_blocks, toxicity  # noqa: F401
from seriesprep.llm.common import ORACLES, QUERIES  # noqa: F401

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
