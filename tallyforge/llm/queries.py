"""The registered queries of the corpus operators, and SQL twins where SQL can say the same."""

from __future__ import annotations

from tallyforge.llm import chat, counts, decontam, embeddings, jaccard, language, merkle, packing, repair, scoring, secrets, store, toxicity, twins

QUERIES = {
    "op1_suffix_tree_score": scoring.op1,
    "op2_language": language.op2,
    "op3_decontaminate": decontam.op3,
    "op4_token_store": store.op4,
    "op5_token_counts": counts.op5,
    "op6_embedding_links": embeddings.op6,
    "op7_pack_sequences": packing.op7,
    "op8_secret_scan": secrets.op8,
    "op9_toxicity": toxicity.op9,
    "op10_shingle_join": jaccard.op10,
    "op11_conversation_repair": repair.op11,
    "op12_merkle_manifest": merkle.op12,
    "op13_chat_format": chat.op13,
}

SQL = {
    "op3_decontaminate": twins.DECONTAMINATE, "op6_embedding_links": twins.EMBEDDINGS, "op8_secret_scan": twins.SECRETS, "op10_shingle_join": twins.JACCARD, "op11_conversation_repair": twins.REPAIR, "op12_merkle_manifest": twins.MERKLE, "op13_chat_format": twins.CHAT,
}
