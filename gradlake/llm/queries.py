"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from gradlake.llm import bpe, decontaminate, lines, merkle, packing, pages, quality, repair, secrets, simhash, spelling, topk, urls

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_leaks": decontaminate.op2_leaks,
    "op3_merkle": merkle.op3_merkle,
    "op4_pages": pages.op4_pages,
    "op5_lines": lines.op5_lines,
    "op6_secrets": secrets.op6_secrets,
    "op7_urls": urls.op7_urls,
    "op8_simhash": simhash.op8_simhash,
    "op9_topk": topk.op9_topk,
    "op10_bpe": bpe.op10_bpe,
    "op11_spelling": spelling.op11_spelling,
    "op12_packing": packing.op12_packing,
    "op13_repair": repair.op13_repair,
}

ORACLES = {"op3_merkle": merkle.OP3_SQL, "op5_lines": lines.OP5_SQL, "op9_topk": topk.OP9_SQL, "op11_spelling": spelling.OP11_SQL, "op13_repair": repair.OP13_SQL}
