"""The queries of this subpackage, for the registry at the repository's top."""

from __future__ import annotations

from corpuskit.llm import language_id, license_scan, mixing, packing, quality_ledger, secret_scan, simhash, suffix_dedup, token_scan, topk_search

QUERIES = {
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op8_token_counts": token_scan.op8_token_counts,
    "op6_topk_search": topk_search.op6_topk_search,
    "op2_secret_scan": secret_scan.op2_secret_scan,
    "op3_simhash_near_dedup": simhash.op3_simhash_near_dedup,
    "op1_source_mixing": mixing.op1_source_mixing,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op4_language_id": language_id.op4_language_id,
    "op7_license_scan": license_scan.op7_license_scan,
    "op9_quality_ledger": quality_ledger.op9_quality_ledger,
    "quality_ablations": quality_ledger.quality_ablations,
}

ORACLES: dict[str, str] = {"op6_topk_search": topk_search.OP6_SQL, "op9_quality_ledger": quality_ledger.OP9_SQL, "quality_ablations": quality_ledger.ABLATIONS_SQL}
