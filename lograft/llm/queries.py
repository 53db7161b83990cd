"""Registered queries of the corpus operators and their SQL oracles."""

from __future__ import annotations

from .bpe_backtrack import op12_bpe_backtrack
from .huffman_tokens import op7_huffman_tokens
from .language_id import op2_language_id
from .mixing import OP3_SQL, op3_source_mix
from .nearest_neighbours import op1_nearest_neighbours
from .piece_viterbi import op8_piece_viterbi
from .simhash_dedup import op9_simhash_dedup
from .source_divergence import OP11_SQL, op11_source_divergence
from .suffix_dedup import op10_suffix_dedup
from .toxicity import op4_toxicity
from .vector_codes import op13_vector_codes
from .vector_dedup import OP6_SQL, op6_vector_dedup
from .warc_zstd import OP5_SQL, op5_warc_zstd

REGISTRY = {
    "op1_nearest_neighbours": op1_nearest_neighbours,
    "op2_language_id": op2_language_id,
    "op3_source_mix": op3_source_mix,
    "op4_toxicity": op4_toxicity,
    "op5_warc_zstd": op5_warc_zstd,
    "op6_vector_dedup": op6_vector_dedup,
    "op7_huffman_tokens": op7_huffman_tokens,
    "op8_piece_viterbi": op8_piece_viterbi,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_bpe_backtrack": op12_bpe_backtrack,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op3_source_mix": OP3_SQL,
    "op5_warc_zstd": OP5_SQL,
    "op6_vector_dedup": OP6_SQL,
    "op11_source_divergence": OP11_SQL,
}
