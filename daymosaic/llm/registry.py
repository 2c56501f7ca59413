"""Queries of this subpackage and the SQL of those that SQL can express."""

from daymosaic.llm import (
    op1_pii, op2_mix, op3_lm, op4_chat, op5_quality, op6_licence, op7_minhash, op8_shard, op9_decontaminate, op10_toxicity,
    op11_prefix_trie, op12_hard_negatives, op13_packing, pipeline,
)

QUERIES = {
    "op1_pii": op1_pii.query,
    "op2_mix": op2_mix.query,
    "op3_lm": op3_lm.query,
    "op4_chat": op4_chat.query,
    "op5_quality": op5_quality.query,
    "op6_licence": op6_licence.query,
    "op7_minhash": op7_minhash.query,
    "op8_shard": op8_shard.query,
    "op9_decontaminate": op9_decontaminate.query,
    "op10_toxicity": op10_toxicity.query,
    "op11_prefix_trie": op11_prefix_trie.query,
    "op12_hard_negatives": op12_hard_negatives.query,
    "op13_packing": op13_packing.query,
    "pipeline": pipeline.run,
}

ORACLES = {
    "op4_chat": op4_chat.SQL,
    "op5_quality": op5_quality.SQL,
    "op8_shard": op8_shard.SQL,
    "op9_decontaminate": op9_decontaminate.SQL,
    "op11_prefix_trie": op11_prefix_trie.SQL,
    "op12_hard_negatives": op12_hard_negatives.SQL,
}
