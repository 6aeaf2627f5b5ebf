"""The queries of this package, and SQL for those that it can express."""

from __future__ import annotations

from . import licenses, vector_codes
from .bpe_index import op6_bpe_pair_index
from .conversation_repair import op13_survivor_repair
from .language import op9_language_subwords
from .licenses import op4_license_scan
from .line_runs import op2_line_runs
from .orc_tokens import op10_orc_tokens
from .overlap_join import op5_shingle_overlap
from .packing import op3_sequence_packing
from .phrases import op7_phrase_fingerprints
from .piece_merges import op12_piece_backtracking
from .quality import op8_quality_divergence
from .suffix_tree import op1_suffix_tree_scores
from .vector_codes import op11_mask_codes

QUERIES = {
    "op1_suffix_tree_scores": op1_suffix_tree_scores,
    "op2_line_runs": op2_line_runs,
    "op3_sequence_packing": op3_sequence_packing,
    "op4_license_scan": op4_license_scan,
    "op5_shingle_overlap": op5_shingle_overlap,
    "op6_bpe_pair_index": op6_bpe_pair_index,
    "op7_phrase_fingerprints": op7_phrase_fingerprints,
    "op8_quality_divergence": op8_quality_divergence,
    "op9_language_subwords": op9_language_subwords,
    "op10_orc_tokens": op10_orc_tokens,
    "op11_mask_codes": op11_mask_codes,
    "op12_piece_backtracking": op12_piece_backtracking,
    "op13_survivor_repair": op13_survivor_repair,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op4_license_scan": licenses.ORACLE, "op11_mask_codes": vector_codes.ORACLE}
