"""Queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from caremill.llm import impacts, licences
from caremill.llm.align import op12_alignment
from caremill.llm.decontaminate import op10_decontamination
from caremill.llm.idfiles import op6_token_ids
from caremill.llm.language import op8_language_id
from caremill.llm.near import op4_near_dedup
from caremill.llm.pack import op2_packing
from caremill.llm.repeats import op3_substring_dedup
from caremill.llm.suffixes import op9_suffix_dedup
from caremill.llm.toxicity import op7_toxicity
from caremill.llm.vectors import op5_embedding_dedup
from caremill.llm.whitening import op13_whitening

QUERIES = {
    "op1_license_scan": licences.op1_license_scan,
    "op2_packing": op2_packing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_near_dedup": op4_near_dedup,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_token_ids": op6_token_ids,
    "op7_toxicity": op7_toxicity,
    "op8_language_id": op8_language_id,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_exact_top_k": impacts.op11_exact_top_k,
    "op12_alignment": op12_alignment,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {"op1_license_scan": licences.oracle(), "op11_exact_top_k": impacts.oracle()}
