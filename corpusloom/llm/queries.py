"""One query for each operator of this package, and the same in DuckDB SQL where that can express it."""

from __future__ import annotations

from corpusloom.llm.bpe import op8_bpe
from corpusloom.llm.html_text import op10_html_text
from corpusloom.llm.language import op5_language_id
from corpusloom.llm.line_dedup import OP4_SQL, op4_line_dedup
from corpusloom.llm.merkle import OP11_SQL, op11_merkle
from corpusloom.llm.mixing import op13_lm_score
from corpusloom.llm.near_dedup import OP3_SQL, op3_near_dedup
from corpusloom.llm.packing import op6_packing
from corpusloom.llm.quality import OP1_SQL, op1_quality_rules
from corpusloom.llm.sharding import op2_sharding
from corpusloom.llm.topk import OP9_SQL, op9_top_k
from corpusloom.llm.toxicity import op7_toxicity
from corpusloom.llm.trie import OP12_SQL, op12_prefix_trie

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_sharding": op2_sharding,
    "op3_near_dedup": op3_near_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_language_id": op5_language_id,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_bpe": op8_bpe,
    "op9_top_k": op9_top_k,
    "op10_html_text": op10_html_text,
    "op11_merkle": op11_merkle,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_lm_score": op13_lm_score,
}
ORACLE_SQL = {
    "op1_quality_rules": OP1_SQL,
    "op3_near_dedup": OP3_SQL,
    "op4_line_dedup": OP4_SQL,
    "op9_top_k": OP9_SQL,
    "op11_merkle": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
}
