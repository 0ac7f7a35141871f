"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from canonix.llm.bpe import op2_byte_bpe
from canonix.llm.chat import OP8_SQL, op8_chat_formatting
from canonix.llm.decontaminate import OP10_SQL, op10_decontamination
from canonix.llm.lines import op1_line_dedup
from canonix.llm.mixing import OP11_SQL, op11_source_mixing
from canonix.llm.nearest import op9_nearest_neighbours
from canonix.llm.neardup import op5_ngram_jaccard_join
from canonix.llm.packing import op4_packed_tokens
from canonix.llm.phrases import OP12_SQL, op12_phrase_mining
from canonix.llm.quality import op3_quality_classifier
from canonix.llm.resample import OP13_SQL, op13_importance_resampling
from canonix.llm.shard import op7_sharding
from canonix.llm.substrings import OP6_SQL, op6_substring_dedup

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_packed_tokens": op4_packed_tokens,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_sharding": op7_sharding,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_decontamination": op10_decontamination,
    "op11_source_mixing": op11_source_mixing,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_importance_resampling": op13_importance_resampling,
}
SQL = {
    "op6_substring_dedup": OP6_SQL,
    "op8_chat_formatting": OP8_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_source_mixing": OP11_SQL,
    "op12_phrase_mining": OP12_SQL,
    "op13_importance_resampling": OP13_SQL,
}
