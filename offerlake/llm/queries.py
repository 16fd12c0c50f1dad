"""Registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from offerlake.llm.decontaminate import OP11_SQL, op11_decontaminate
from offerlake.llm.licences import OP5_SQL, op5_licence_scan
from offerlake.llm.mixing import op1_mix_sources
from offerlake.llm.ngram_join import op10_ngram_jaccard
from offerlake.llm.pii import op3_pii
from offerlake.llm.pieces import op8_sentencepiece
from offerlake.llm.quality import OP2_SQL, op2_quality_rules
from offerlake.llm.sharding import op7_rendezvous_shards
from offerlake.llm.spelling import OP12_SQL, op12_spelling_variants
from offerlake.llm.suffix_dedup import op6_suffix_dedup
from offerlake.llm.topk import OP4_SQL, op4_block_top_k
from offerlake.llm.toxicity import op9_toxicity
from offerlake.llm.whitening import op13_whitening

QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_decontaminate": op11_decontaminate,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_whitening": op13_whitening,
    "op2_quality_rules": op2_quality_rules,
    "op3_pii": op3_pii,
    "op4_block_top_k": op4_block_top_k,
    "op5_licence_scan": op5_licence_scan,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_rendezvous_shards": op7_rendezvous_shards,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_toxicity": op9_toxicity,
}

ORACLES = {
    "op11_decontaminate": OP11_SQL,
    "op12_spelling_variants": OP12_SQL,
    "op2_quality_rules": OP2_SQL,
    "op4_block_top_k": OP4_SQL,
    "op5_licence_scan": OP5_SQL,
}
