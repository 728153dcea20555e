"""The registered queries of this subpackage and their DuckDB twins where SQL can express them."""

from . import (byte_bpe, embedding_dedup, hard_negatives, langid, line_dedup, mixing, ngram_join, prefix_trie, quality, simhash,
               toxicity, warc, word_bpe)

REGISTRY = {
    "op1_ngram_jaccard_join": ngram_join.op1_ngram_jaccard_join,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_byte_bpe": byte_bpe.op5_byte_bpe,
    "op6_simhash": simhash.op6_simhash,
    "op7_warc": warc.op7_warc,
    "op8_language_id": langid.op8_language_id,
    "op9_quality": quality.op9_quality,
    "op10_embedding_dedup": embedding_dedup.op10_embedding_dedup,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_word_bpe": word_bpe.op13_word_bpe,
}

SQL = {
    "op4_line_dedup": line_dedup.OP4_SQL,
    "op7_warc": warc.OP7_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op12_prefix_trie": prefix_trie.OP12_SQL,
}
