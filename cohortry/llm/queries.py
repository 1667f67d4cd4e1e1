"""The registered queries of the corpus operators, and the SQL they are compared with where SQL can express them."""

from __future__ import annotations

from cohortry.llm.learned_partitions import op2_learned_partitions
from cohortry.llm.lexical_search import OP12_SQL, op12_dense_search
from cohortry.llm.line_chunks import OP10_SQL, op10_line_chunks
from cohortry.llm.mixing import OP4_SQL, op4_mixing
from cohortry.llm.near_duplicates import OP6_SQL, op6_near_duplicates
from cohortry.llm.packing import op9_packing
from cohortry.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from cohortry.llm.quality_rules import op5_quality_rules
from cohortry.llm.quality_trees import op3_quality_trees
from cohortry.llm.recompression import OP1_SQL, op1_recompression
from cohortry.llm.sharding import OP13_SQL, op13_interleaved_shards
from cohortry.llm.token_counts import op8_token_counts
from cohortry.llm.toxicity import op7_toxicity

REGISTRY = {
    "op1_recompression": op1_recompression,
    "op2_learned_partitions": op2_learned_partitions,
    "op3_quality_trees": op3_quality_trees,
    "op4_mixing": op4_mixing,
    "op5_quality_rules": op5_quality_rules,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_packing": op9_packing,
    "op10_line_chunks": op10_line_chunks,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_dense_search": op12_dense_search,
    "op13_interleaved_shards": op13_interleaved_shards,
}

ORACLES: dict[str, str] = {
    "op1_recompression": OP1_SQL,
    "op4_mixing": OP4_SQL,
    "op6_near_duplicates": OP6_SQL,
    "op10_line_chunks": OP10_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_dense_search": OP12_SQL,
    "op13_interleaved_shards": OP13_SQL,
}
