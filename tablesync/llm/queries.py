"""The queries of the corpus operators and their SQL, where SQL can express them."""

from __future__ import annotations

from tablesync.llm import (
    align, bagminhash, chat, decontaminate, hamming, html, language, merkle, mixing, sharding, suffixes, surrogates,
    warc,
)

QUERIES = {
    "op1_warc": warc.op1,
    "op2_sharding": sharding.op2,
    "op3_near_duplicates": bagminhash.op3,
    "op4_repeated_strings": suffixes.op4,
    "op5_hamming_search": hamming.op5,
    "op6_decontamination": decontaminate.op6,
    "op7_language": language.op7,
    "op8_mixing": mixing.op8,
    "op9_main_text": html.op9,
    "op10_surrogates": surrogates.op10,
    "op11_manifest": merkle.op11,
    "op12_chat": chat.op12,
    "op13_alignment": align.op13,
}

ORACLE = {
    "op1_warc": warc.ORACLE,
    "op5_hamming_search": hamming.ORACLE,
    "op6_decontamination": decontaminate.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op11_manifest": merkle.ORACLE,
    "op12_chat": chat.ORACLE,
}
