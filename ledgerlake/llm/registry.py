"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from ledgerlake.llm import (chat, decontaminate, jaccard, licenses, minhash, negatives,
                            packing, phrases, quality_model, quality_rules, sharding, substring, wavelet)

QUERIES = {
    "op1_quality_scores": quality_model.op1_quality_scores,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_substring_dedup": substring.op3_substring_dedup,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_jaccard_join": jaccard.op5_jaccard_join,
    "op6_token_shards": wavelet.op6_token_shards,
    "op7_format_chats": chat.op7_format_chats,
    "op8_shard_documents": sharding.op8_shard_documents,
    "op9_pack_documents": packing.op9_pack_documents,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_phrase_collocations": phrases.op11_phrase_collocations,
    "op12_minhash_near_dedup": minhash.op12_minhash_near_dedup,
    "op13_hard_negatives": negatives.op13_hard_negatives,
}

ORACLES = {
    "op3_substring_dedup": substring.OP3_SQL,
    "op5_jaccard_join": jaccard.OP5_SQL,
    "op4_license_scan": licenses.OP4_SQL,
    "op7_format_chats": chat.OP7_SQL,
    "op10_quality_rules": quality_rules.OP10_SQL,
    "op11_phrase_collocations": phrases.OP11_SQL,
    "op12_minhash_near_dedup": minhash.OP12_SQL,
    "op13_hard_negatives": negatives.OP13_SQL,
}
