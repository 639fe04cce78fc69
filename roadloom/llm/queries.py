"""Queries of this folder and their SQL, by name."""

from __future__ import annotations

from roadloom.llm.chunkdedup import op2_gear_chunks
from roadloom.llm.exact import OP5_SQL, op5_chunk_recipes
from roadloom.llm.filteraudit import OP12_SQL, op12_filter_audit
from roadloom.llm.langid import op8_marginal_unigrams
from roadloom.llm.lexical import OP11_SQL, op11_hybrid_search
from roadloom.llm.minhash import OP3_SQL, op3_bayes_minhash
from roadloom.llm.packing import op6_concat_cut
from roadloom.llm.sampling import op4_gumbel_topk
from roadloom.llm.sharding import op9_uniform_shards
from roadloom.llm.toxicity import op7_lexicon_automata
from roadloom.llm.suffixes import op10_radix_windows
from roadloom.llm.tokenfiles import op13_token_files
from roadloom.llm.topk import OP1_SQL, op1_exact_topk

QUERIES = {
    "op1_exact_topk": op1_exact_topk,
    "op2_gear_chunks": op2_gear_chunks,
    "op3_bayes_minhash": op3_bayes_minhash,
    "op4_gumbel_topk": op4_gumbel_topk,
    "op5_chunk_recipes": op5_chunk_recipes,
    "op6_concat_cut": op6_concat_cut,
    "op7_lexicon_automata": op7_lexicon_automata,
    "op8_marginal_unigrams": op8_marginal_unigrams,
    "op9_uniform_shards": op9_uniform_shards,
    "op10_radix_windows": op10_radix_windows,
    "op11_hybrid_search": op11_hybrid_search,
    "op12_filter_audit": op12_filter_audit,
    "op13_token_files": op13_token_files,
}

ORACLE_SQL = {
    "op1_exact_topk": OP1_SQL,
    "op3_bayes_minhash": OP3_SQL,
    "op5_chunk_recipes": OP5_SQL,
    "op11_hybrid_search": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
}
