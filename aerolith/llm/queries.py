"""The registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from aerolith.llm import (
    op1_toxicity,
    op2_warc,
    op3_urlfilter,
    op4_extract,
    op5_topk,
    op6_shard,
    op7_decontaminate,
    op8_mix,
    op9_orderminhash,
    op10_repeats,
    op11_packing,
    op12_collocations,
    op13_manifest,
)

QUERIES = {
    "op1_fm_toxicity": op1_toxicity.query,
    "op2_warc_bundles": op2_warc.query,
    "op3_url_filter": op3_urlfilter.query,
    "op4_main_text": op4_extract.query,
    "op5_nra_topk": op5_topk.query,
    "op6_extendible_shards": op6_shard.query,
    "op7_spaced_seed_leaks": op7_decontaminate.query,
    "op8_fair_mix": op8_mix.query,
    "op9_order_minhash": op9_orderminhash.query,
    "op10_suffix_repeats": op10_repeats.query,
    "op11_dominance_packing": op11_packing.query,
    "op12_dynamic_collocations": op12_collocations.query,
    "op13_slot_pivot_manifest": op13_manifest.query,
}

ORACLE = {
    "op2_warc_bundles": op2_warc.SQL,
    "op3_url_filter": op3_urlfilter.SQL,
    "op5_nra_topk": op5_topk.SQL,
    "op6_extendible_shards": op6_shard.SQL,
    "op8_fair_mix": op8_mix.SQL,
    "op12_dynamic_collocations": op12_collocations.SQL,
    "op13_slot_pivot_manifest": op13_manifest.SQL,
}
