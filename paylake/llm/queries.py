"""Registered queries of this subpackage and their oracles."""

from __future__ import annotations

from paylake.llm import align, bpe, chat, cover, decontaminate, jaccard, mixing, packing, pii, quality, substrings, trie, warc


def queries() -> dict:
    return {"op1_quality": quality.op1_quality, "op2_pii": pii.op2_pii, "op3_packing": packing.op3_packing, "op4_chat": chat.op4_chat, "op5_decontamination": decontaminate.op5_decontamination, "op6_mixing": mixing.op6_mixing, "op7_substrings": substrings.op7_substrings, "op8_jaccard": jaccard.op8_jaccard, "op9_embeddings": cover.op9_embeddings, "op10_warc": warc.op10_warc, "op11_alignment": align.op11_alignment, "op12_trie": trie.op12_trie, "op13_bpe": bpe.op13_bpe}


def oracles() -> dict[str, str]:
    return {"op4_chat": chat.ORACLE, "op6_mixing": mixing.ORACLE, "op8_jaccard": jaccard.ORACLE, "op9_embeddings": cover.ORACLE, "op10_warc": warc.ORACLE, "op12_trie": trie.ORACLE}
