"""The corpus operators as queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from tablelift.llm import exact_dedup
from tablelift.llm.alignment import op12_cross_tokenizer_alignment
from tablelift.llm.embedding_dedup import op9_embedding_near_dedup
from tablelift.llm.exact_dedup import op8_exact_dedup
from tablelift.llm.language_id import op5_language_id
from tablelift.llm.line_dedup import op4_line_dedup
from tablelift.llm.lm_scoring import op10_lm_scoring
from tablelift.llm.mixing import op6_source_mixing
from tablelift.llm.near_dedup import op7_minhash_near_dedup
from tablelift.llm.packing import op3_packing
from tablelift.llm.spelling import op11_spelling_variants
from tablelift.llm.templates import op13_html_extraction
from tablelift.llm.token_counts import op2_token_counts
from tablelift.llm.toxicity import op1_toxicity

QUERIES = {f.__name__: f for f in (op1_toxicity, op2_token_counts, op3_packing, op4_line_dedup, op5_language_id, op6_source_mixing, op7_minhash_near_dedup, op8_exact_dedup, op9_embedding_near_dedup, op10_lm_scoring, op11_spelling_variants, op12_cross_tokenizer_alignment, op13_html_extraction)}

ORACLES: dict[str, str] = {"op8_exact_dedup": exact_dedup.SQL}
