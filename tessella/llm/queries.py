"""The operators' queries on the driver's tables and their SQL."""

from __future__ import annotations

from . import hyperminhash, jaccard, mixing, packing, phrases, quality, repair, rlz, suffixes, syncmers, tokens, topk, warc


def queries() -> dict:
    return {
        "op1_warc": warc.op1_warc,
        "op2_tokens": tokens.op2_tokens,
        "op3_packing": packing.op3_packing,
        "op4_quality": quality.op4_quality,
        "op5_jaccard": jaccard.op5_jaccard,
        "op6_suffixes": suffixes.op6_suffixes,
        "op7_mixing": mixing.op7_mixing,
        "op8_topk": topk.op8_topk,
        "op9_fingerprints": syncmers.op9_fingerprints,
        "op10_substrings": rlz.op10_substrings,
        "op11_repair": repair.op11_repair,
        "op12_phrases": phrases.op12_phrases,
        "op13_hyperminhash": hyperminhash.op13_hyperminhash,
    }


def oracle_sql() -> dict:
    return {"op1_warc": warc.OP1_SQL, "op5_jaccard": jaccard.OP5_SQL, "op7_mixing": mixing.OP7_SQL, "op8_topk": topk.OP8_SQL, "op10_substrings": rlz.OP10_SQL, "op11_repair": repair.OP11_SQL, "op12_phrases": phrases.OP12_SQL, "op13_hyperminhash": hyperminhash.OP13_SQL}
