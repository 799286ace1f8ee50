"""Registered queries of this subpackage.

No oracle SQL: each of them needs something DuckDB SQL lacks (Spark's or a
gear hash, checksums, iterated estimates, compression, model training).  The README
says which whole results ``tests/llm`` holds against brute force, and which in parts.
"""

from __future__ import annotations

from geoscribe.llm.chunks import op6_gear_chunks
from geoscribe.llm.jaccard import op3_pivot_jaccard
from geoscribe.llm.langid import op4_word_backoff_language
from geoscribe.llm.licenses import op10_license_paragraphs
from geoscribe.llm.mixing import op8_pivotal_mix
from geoscribe.llm.pieces import op13_distinct_chunk_pieces
from geoscribe.llm.quality import op1_mcd_quality
from geoscribe.llm.secrets import op7_novelty_secrets
from geoscribe.llm.sharding import op9_interleaved_shards
from geoscribe.llm.templates import op5_template_decontamination
from geoscribe.llm.turns import op12_run_length_repair
from geoscribe.llm.url_ratio import op2_url_model_ratio
from geoscribe.llm.whitening import op11_cholesky_whitening

QUERIES = {f.__name__: f for f in (
    op1_mcd_quality,
    op2_url_model_ratio,
    op3_pivot_jaccard,
    op4_word_backoff_language,
    op5_template_decontamination,
    op6_gear_chunks,
    op7_novelty_secrets,
    op8_pivotal_mix,
    op9_interleaved_shards,
    op10_license_paragraphs,
    op11_cholesky_whitening,
    op12_run_length_repair,
    op13_distinct_chunk_pieces,
)}

ORACLE_SQL: dict[str, str] = {}
