"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from . import oracles
from .automaton_dedup import op4_substring_dedup
from .decontamination import op6_benchmark_decontamination
from .hard_negatives import op13_hard_negatives
from .jaccard_join import op5_jaccard_join
from .language_id import op7_language_id, op7_page_languages
from .mixing import op10_mixing
from .pii import op3_pii_surrogates
from .quality_rules import op1_quality_rules
from .sharding import op12_kd_sharding
from .site_style_tree import op8_html_extraction
from .spelling import op11_spelling_variants
from .suffix_dedup import op2_suffix_array_dedup
from .token_counts import op9_token_counts

QUERIES = {"op1_quality_rules": op1_quality_rules, "op2_suffix_array_dedup": op2_suffix_array_dedup, "op3_pii_surrogates": op3_pii_surrogates, "op4_substring_dedup": op4_substring_dedup, "op5_jaccard_join": op5_jaccard_join, "op6_benchmark_decontamination": op6_benchmark_decontamination, "op7_language_id": op7_language_id, "op7_page_languages": op7_page_languages, "op8_html_extraction": op8_html_extraction, "op9_token_counts": op9_token_counts, "op10_mixing": op10_mixing, "op11_spelling_variants": op11_spelling_variants, "op12_kd_sharding": op12_kd_sharding, "op13_hard_negatives": op13_hard_negatives}
ORACLES = {"op2_suffix_array_dedup": oracles.REPEATED_BYTES, "op4_substring_dedup": oracles.REPEATED_WORDS, "op5_jaccard_join": oracles.NEAR_COPIES, "op11_spelling_variants": oracles.SPELLING, "op13_hard_negatives": oracles.HARD_NEGATIVES}
