"""The numbered queries and their SQL, where SQL can express them."""

from __future__ import annotations

from martflow.llm import conversations, lines, mixing, neardup, negatives, passages, quality, secrets, simhash, tokenfiles, tokens, urls, vectors

ENTRIES = {
    "op1_quality_gam": (quality.query, None),
    "op2_simhash": (simhash.query, None),
    "op3_byte_bpe": (tokens.query, None),
    "op4_token_files": (tokenfiles.query, None),
    "op5_secret_ledger": (secrets.query, None),
    "op6_setsketch": (neardup.query, None),
    "op7_passages": (passages.query, passages.SQL),
    "op8_line_shards": (lines.query, lines.SQL),
    "op9_posting_lists": (vectors.query, None),
    "op10_source_mix": (mixing.query, mixing.SQL),
    "op11_turn_repair": (conversations.query, None),
    "op12_url_filter": (urls.query, None),
    "op13_angular_negatives": (negatives.query, None),
}
