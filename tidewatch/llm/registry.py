"""Queries of this package: name -> (spark, sf_dir) builder, and DuckDB SQL where SQL can express them."""
from __future__ import annotations

from tidewatch.llm import alignment, centroids, chat, curve_packing, decontam, katz, licenses, ngram_join, packing, quality, secret_scan, toxicity, urls

QUERIES = {
    "op1_quality_rules": quality.q_op1,
    "op2_toxicity": toxicity.q_op2,
    "op3_benchmark_decontamination": decontam.q_op3,
    "op4_license_scans": licenses.q_op4,
    "op5_chat_formatting": chat.q_op5,
    "op6_best_fit_packing": packing.q_op6,
    "op7_katz_scores": katz.q_op7,
    "op8_ngram_jaccard_join": ngram_join.q_op8,
    "op9_url_filters": urls.q_op9,
    "op10_secret_scans": secret_scan.q_op10,
    "op11_curve_packing": curve_packing.q_op11,
    "op12_cross_tokenizer_alignment": alignment.q_op12,
    "op13_centroid_clustering": centroids.q_op13,
}
ORACLE = {
    "op1_quality_rules": quality.ORACLE_OP1,
    "op4_license_scans": licenses.ORACLE_OP4,
    "op5_chat_formatting": chat.ORACLE_OP5,
    "op9_url_filters": urls.ORACLE_OP9,
    "op13_centroid_clustering": centroids.ORACLE_OP13,
}
