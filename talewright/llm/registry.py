"""Queries and SQL of this subpackage."""

from __future__ import annotations

from . import bpe, decontaminate, jpeg, licenses, minhash, secrets, suffix, tokenfile, toxicity, warc


def queries():
    return {
        "op1_licenses": licenses.op1_licenses,
        "op2_secrets": secrets.op2_secrets,
        "op3_toxicity": toxicity.op3_toxicity,
        "op4_decontaminate": decontaminate.op4_decontaminate,
        "op5_bpe": bpe.op5_bpe,
        "op6_media": jpeg.op6_media,
        "op7_tokens": tokenfile.op7_tokens,
        "op8_minhash": minhash.op8_minhash,
        "op9_warc": warc.op9_warc,
        "op10_suffix": suffix.op10_suffix,
        "media_payload": jpeg.media_payload,
    }


def oracle_sql():
    return {"op1_licenses": licenses.OP1_SQL, "op2_secrets": secrets.OP2_SQL, "media_payload": jpeg.MEDIA_PAYLOAD_SQL, "op10_suffix": suffix.OP10_SQL, "op8_minhash": minhash.OP8_SQL, "op4_decontaminate": decontaminate.OP4_SQL, "op9_warc": warc.OP9_SQL}
