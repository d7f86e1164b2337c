"""The queries of this folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from strandline.llm import alignment, bpe, contamination, language, lines, neardup, neighbours, pii, planes, quality, secrets, toolcalls, trie

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_hnsw": neighbours.op2_hnsw,
    "op3_tool_calls": toolcalls.op3_tool_calls,
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_token_efficiency": secrets.op5_token_efficiency,
    "op6_byte_bpe": bpe.op6_byte_bpe,
    "op7_quality": quality.op7_quality,
    "op8_order_minhash": neardup.op8_order_minhash,
    "op9_positional_index": contamination.op9_positional_index,
    "op10_language_id": language.op10_language_id,
    "op11_planes": planes.op11_planes,
    "op12_alignment": alignment.op12_alignment,
    "op13_prefix_trie": trie.op13_prefix_trie,
}
ORACLES: dict[str, str] = {"op3_tool_calls": toolcalls.OP3_SQL, "op9_positional_index": contamination.OP9_SQL, "op13_prefix_trie": trie.OP13_SQL}
