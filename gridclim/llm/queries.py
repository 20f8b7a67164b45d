"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from .audit import OP13_SQL, op13_filter_cube
from .chat import OP3_SQL, op3_perspective_rotation
from .decontaminate import op10_suffix_array_decontamination
from .gif import op1_gif_media
from .langid import op5_language_id
from .mixing import OP7_SQL, op7_golden_mixture
from .runs import op12_lyndon_runs
from .setsketch import op9_setsketch_near_duplicates
from .suffixes import op4_repeated_strings
from .tokens import op2_token_counts, op6_token_files
from .toxicity import op8_toxicity_chain
from .vectors import OP11_SQL, op11_approximation_search

QUERIES = {
    "op1_gif_media": op1_gif_media,
    "op2_token_counts": op2_token_counts,
    "op3_perspective_rotation": op3_perspective_rotation,
    "op4_repeated_strings": op4_repeated_strings,
    "op5_language_id": op5_language_id,
    "op6_token_files": op6_token_files,
    "op7_golden_mixture": op7_golden_mixture,
    "op8_toxicity_chain": op8_toxicity_chain,
    "op9_setsketch_near_duplicates": op9_setsketch_near_duplicates,
    "op10_suffix_array_decontamination": op10_suffix_array_decontamination,
    "op11_approximation_search": op11_approximation_search,
    "op12_lyndon_runs": op12_lyndon_runs,
    "op13_filter_cube": op13_filter_cube,
}
ORACLES: dict[str, str] = {"op3_perspective_rotation": OP3_SQL, "op7_golden_mixture": OP7_SQL, "op11_approximation_search": OP11_SQL, "op13_filter_cube": OP13_SQL}
