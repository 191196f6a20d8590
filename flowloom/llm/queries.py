"""The queries of this package by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from .bpe import op6_bpe
from .decontamination import op3_decontamination
from .exact_dedup import OP5_SQL, op5_exact_dedup
from .jaccard_join import OP7_SQL, op7_jaccard_join
from .language_id import op8_language_id, pages_language_id
from .pii import op2_pii
from .quality import op4_quality
from .substring_dedup import OP1_SQL, op1_substring_dedup
from .suffix_dedup import OP10_SQL, op10_suffix_dedup
from .token_files import op9_token_files

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_pii": op2_pii,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_bpe": op6_bpe,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_language_id": op8_language_id,
    "op9_token_files": op9_token_files,
    "op10_suffix_dedup": op10_suffix_dedup,
    "pages_language_id": pages_language_id,
}
SQL = {"op1_substring_dedup": OP1_SQL, "op5_exact_dedup": OP5_SQL, "op7_jaccard_join": OP7_SQL, "op10_suffix_dedup": OP10_SQL}
