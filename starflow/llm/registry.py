"""The subpackage's driver queries and their DuckDB twins."""

from __future__ import annotations

from starflow.llm import chat, decontaminate, huffman, lines, minhash, packing, quality, repeats, runs, sharding, spelling, urls, warc

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_quality": quality.op2_quality,
    "op3_quotes": chat.op3_quotes,
    "op4_lines": lines.op4_lines,
    "op5_sharding": sharding.op5_sharding,
    "op6_minhash": minhash.op6_minhash,
    "op7_repeats": repeats.op7_repeats,
    "op8_packing": packing.op8_packing,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_token_ids": huffman.op10_token_ids,
    "op11_runs": runs.op11_runs,
    "op12_urls": urls.op12_urls,
    "op13_spelling": spelling.op13_spelling,
}

ORACLE_SQL = {
    "op1_warc": warc.OP1_SQL,
    "op3_quotes": chat.OP3_SQL,
    "op4_lines": lines.OP4_SQL,
    "op11_runs": runs.OP11_SQL,
    "op13_spelling": spelling.OP13_SQL,
}
