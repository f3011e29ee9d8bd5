"""The registered queries of this folder and their SQL counterparts."""

from __future__ import annotations

from tillstream.llm.chat_format import OP8_SQL, op8_chat_format
from tillstream.llm.conversation_trie import OP12_SQL, op12_conversation_trie
from tillstream.llm.exact_dedup import OP3_SQL, op3_exact_dedup
from tillstream.llm.imatch import OP11_SQL, op11_imatch
from tillstream.llm.jaccard_join import op6_jaccard_join
from tillstream.llm.mixing import OP5_SQL, op5_source_mixing
from tillstream.llm.packing import op10_best_fit_packing
from tillstream.llm.spelling import OP13_SQL, op13_spelling_variants
from tillstream.llm.substring_dedup import op1_substring_dedup
from tillstream.llm.token_counts import op4_token_counts
from tillstream.llm.topk import OP9_SQL, op9_exact_topk
from tillstream.llm.toxicity import op2_toxicity
from tillstream.llm.url_filter import OP7_SQL, op7_url_filter

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_source_mixing": op5_source_mixing,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_url_filter": op7_url_filter,
    "op8_chat_format": op8_chat_format,
    "op9_exact_topk": op9_exact_topk,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_imatch": op11_imatch,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_spelling_variants": op13_spelling_variants,
}

# The others depend on a tokenizer or a learned model, or are too slow in SQL on whole tables
# (repeated windows, set joins); tests check them against brute force.
ORACLES = {
    "op3_exact_dedup": OP3_SQL,
    "op5_source_mixing": OP5_SQL,
    "op7_url_filter": OP7_SQL,
    "op8_chat_format": OP8_SQL,
    "op9_exact_topk": OP9_SQL,
    "op11_imatch": OP11_SQL,
    "op12_conversation_trie": OP12_SQL,
    "op13_spelling_variants": OP13_SQL,
}
