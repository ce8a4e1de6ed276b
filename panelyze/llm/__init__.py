"""Operators for large training corpora; one module per operator.

``QUERIES`` maps each query name to ``fn(spark, sf_dir)``, ``ORACLE_SQL`` the
names that SQL can express to their DuckDB form.
"""

from panelyze.llm import (
    embeddings,
    mixing,
    neardup,
    negatives,
    packing,
    pieces,
    pii,
    substrings,
    suffixes,
    topk,
    toxicity,
    trie,
    warc,
)

QUERIES = {
    "op1_compression_toxicity": toxicity.op1_compression_toxicity,
    "op2_nnls_packing": packing.op2_nnls_packing,
    "op3_systematic_mixing": mixing.op3_systematic_mixing,
    "op4_hamming_near_duplicates": neardup.op4_hamming_near_duplicates,
    "op5_bit_sliced_topk": topk.op5_bit_sliced_topk,
    "op6_warc_revisits": warc.op6_warc_revisits,
    "op7_seed_extend_substrings": substrings.op7_seed_extend_substrings,
    "op8_multi_index_vectors": embeddings.op8_multi_index_vectors,
    "op9_suffix_merge_sort": suffixes.op9_suffix_merge_sort,
    "op10_skip_chain_pii": pii.op10_skip_chain_pii,
    "op11_block_hash_trie": trie.op11_block_hash_trie,
    "op12_piece_agenda": pieces.op12_piece_agenda,
    "op13_cover_tree_negatives": negatives.op13_cover_tree_negatives,
}

ORACLE_SQL = {
    "op3_systematic_mixing": mixing.SQL,
    "op5_bit_sliced_topk": topk.SQL,
    "op6_warc_revisits": warc.SQL,
    "op11_block_hash_trie": trie.SQL,
    "op13_cover_tree_negatives": negatives.SQL,
}
