"""The queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from netsift.llm.decontaminate import op4_benchmark_decontamination
from netsift.llm.extract import op10_wrapper_main_text
from netsift.llm.languages import op1_language_mixture
from netsift.llm.lines import OP3_SQL, op3_line_dedup
from netsift.llm.middle import OP13_SQL, op13_displacement_middle
from netsift.llm.near import op9_dart_near_duplicates
from netsift.llm.packing import op7_cost_balanced_packing
from netsift.llm.phrases import OP11_SQL, op11_phrase_collocations
from netsift.llm.quality import op5_robust_quality
from netsift.llm.scoring import op6_context_mixing
from netsift.llm.substrings import op2_repeated_substrings
from netsift.llm.tokenfiles import op12_mixed_id_files
from netsift.llm.wordpiece import op8_longest_match_counts

QUERIES = {
    "op1_language_mixture": op1_language_mixture,
    "op2_repeated_substrings": op2_repeated_substrings,
    "op3_line_dedup": op3_line_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_robust_quality": op5_robust_quality,
    "op6_context_mixing": op6_context_mixing,
    "op7_cost_balanced_packing": op7_cost_balanced_packing,
    "op8_longest_match_counts": op8_longest_match_counts,
    "op9_dart_near_duplicates": op9_dart_near_duplicates,
    "op10_wrapper_main_text": op10_wrapper_main_text,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_mixed_id_files": op12_mixed_id_files,
    "op13_displacement_middle": op13_displacement_middle,
}

ORACLE: dict[str, str] = {
    "op3_line_dedup": OP3_SQL,
    "op11_phrase_collocations": OP11_SQL,
    "op13_displacement_middle": OP13_SQL,
}
