"""The queries of this package and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from . import chat, decontam, hnsw, mixing, packing, parity, prefixfree, prefixtrie, ptolemy, quality, secrets, simple8b, store, triecount


def op8_token_binary(spark, sf_dir):
    """All rows of ``documents``. Null texts are empty and get their end id; a null doc_id stands first; rows of one doc_id stand in order of text;
    other columns are ignored; an empty table gives no rows."""
    return simple8b.token_file(store.table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_classifier": quality.op1_quality_classifier,
    "op2_chat_formatting": chat.op2_chat_formatting,
    "op3_benchmark_decontamination": decontam.op3_benchmark_decontamination,
    "op4_ngram_jaccard": parity.op4_ngram_jaccard,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_soft_mixing": mixing.op6_soft_mixing,
    "op7_embedding_near_dedup": hnsw.op7_embedding_near_dedup,
    "op8_token_binary": op8_token_binary,
    "op9_suffix_dedup": prefixfree.op9_suffix_dedup,
    "op10_token_counts": triecount.op10_token_counts,
    "op11_centroid_clustering": ptolemy.op11_centroid_clustering,
    "op12_conversation_prefix_trie": prefixtrie.op12_conversation_prefix_trie,
    "op13_sum_of_squares_packing": packing.op13_sum_of_squares_packing,
}
ORACLE_SQL = {"op2_chat_formatting": chat.ORACLE, "op4_ngram_jaccard": parity.ORACLE, "op9_suffix_dedup": prefixfree.ORACLE, "op11_centroid_clustering": ptolemy.ORACLE, "op12_conversation_prefix_trie": prefixtrie.ORACLE}
