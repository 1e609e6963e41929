"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from helixtab.llm.fm_index import OP11_SQL, op11_fm_decontamination
from helixtab.llm.imatch import op1_document_fingerprints
from helixtab.llm.license_scan import OP3_SQL, op3_license_scan
from helixtab.llm.lm_scoring import op9_lm_scoring
from helixtab.llm.mixing import OP8_SQL, op8_mix_sources
from helixtab.llm.packing import op7_cost_balanced_packing
from helixtab.llm.phrases import OP12_SQL, op12_phrase_mining
from helixtab.llm.quality_rules import op10_quality_rules
from helixtab.llm.ranked_search import OP13_SQL, op13_ranked_search
from helixtab.llm.secret_scan import op6_secret_scan
from helixtab.llm.simhash_dedup import op2_simhash_dedup
from helixtab.llm.substring_dedup import OP4_SQL, op4_substring_dedup
from helixtab.llm.suffix_dedup import OP5_SQL, op5_suffix_array_dedup

QUERIES = {
    "op1_document_fingerprints": op1_document_fingerprints,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_cost_balanced_packing": op7_cost_balanced_packing,
    "op8_mix_sources": op8_mix_sources,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_quality_rules": op10_quality_rules,
    "op11_fm_decontamination": op11_fm_decontamination,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE_SQL = {"op3_license_scan": OP3_SQL, "op4_substring_dedup": OP4_SQL, "op5_suffix_array_dedup": OP5_SQL, "op8_mix_sources": OP8_SQL, "op11_fm_decontamination": OP11_SQL, "op12_phrase_mining": OP12_SQL, "op13_ranked_search": OP13_SQL}
