"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from tidemark.llm import chat, codes, decontaminate, htmltext, merkle, mixing, packing, pii, quality, secrets, sharding, simhash, warc


def queries() -> dict:
    return {
        "op1_decontaminate": decontaminate.op1,
        "op2_pseudonyms": pii.op2,
        "op3_chat_format": chat.op3,
        "op4_warc": warc.op4,
        "op5_mix_sources": mixing.op5,
        "op6_secrets": secrets.op6,
        "op7_main_text": htmltext.op7,
        "op8_simhash": simhash.op8,
        "op9_shard": sharding.op9,
        "op10_quality": quality.op10,
        "op11_pack": packing.op11,
        "op12_vector_codes": codes.op12,
        "op13_merkle_manifest": merkle.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": decontaminate.OP1_SQL, "op3_chat_format": chat.OP3_SQL, "op4_warc": warc.OP4_SQL, "op12_vector_codes": codes.OP12_SQL, "op13_merkle_manifest": merkle.OP13_SQL}
