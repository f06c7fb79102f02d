"""Registry of this subpackage: queries and their SQL."""

from . import byte_bpe, language_id, line_dedup, mixing, prefix_trie, simhash, sort_means, substring_dedup, token_counts, token_store, topk, vp_search, warc


def queries() -> dict:
    import corpus_pipeline

    found = [
        token_counts.op1_token_counts, line_dedup.op2_line_dedup, simhash.op3_simhash, topk.op4_topk, language_id.op5_language_id,
        vp_search.op6_vp_search, warc.op7_warc, substring_dedup.op8_substring_dedup, byte_bpe.op9_byte_bpe, mixing.op10_mixing,
        prefix_trie.op11_prefix_trie, sort_means.op12_sort_means, token_store.op13_token_store,
    ]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = line_dedup.SQL | topk.SQL | warc.SQL | substring_dedup.SQL | prefix_trie.SQL | sort_means.SQL
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
