"""The registered queries of this package and, where SQL can say the same, their SQL."""

from __future__ import annotations

from adspark.llm import archive, chat, contamination, embeddings, huffman, pages, private, repair, sentences, simhash, substrings, toxicity, trie

QUERIES = {f.__name__: f for f in (
    huffman.op1_token_ids,
    embeddings.op2_embedding_near_dedup,
    contamination.op3_benchmark_decontamination,
    toxicity.op4_toxicity,
    substrings.op5_substring_dedup,
    pages.op6_html_extraction,
    private.op7_pii,
    archive.op8_warc,
    sentences.op9_sentencepiece,
    simhash.op10_simhash_near_dedup,
    trie.op11_prefix_trie,
    repair.op12_structure_repair,
    chat.op13_chat_formatting,
)}
SQL = {
    "op2_embedding_near_dedup": embeddings.SQL,
    "op3_benchmark_decontamination": contamination.SQL,
    "op5_substring_dedup": substrings.SQL,
    "op8_warc": archive.SQL,
    "op11_prefix_trie": trie.SQL,
    "op12_structure_repair": repair.SQL,
    "op13_chat_formatting": chat.SQL,
}
