"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from tallyfold.llm import (
    centroids,
    fingerprints,
    grading,
    importance,
    language,
    licenses,
    line_dedup,
    mixing,
    personal,
    pieces,
    quality_rules,
    secrets,
    shingle_join,
)

QUERIES = {
    "op1_quality_grades": grading.op1_quality_grades,
    "op2_language_id": language.op2_language_id,
    "op3_weighted_fingerprints": fingerprints.op3_weighted_fingerprints,
    "op4_piece_sampling": pieces.op4_piece_sampling,
    "op5_license_scans": licenses.op5_license_scans,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_shingle_join": shingle_join.op9_shingle_join,
    "op10_secret_scans": secrets.op10_secret_scans,
    "op11_importance_resampling": importance.op11_importance_resampling,
    "op12_centroid_clustering": centroids.op12_centroid_clustering,
    "op13_personal_data": personal.op13_personal_data,
}
CHECKS = {
    "op5_license_scans": licenses.OP5_SQL,
    "op6_line_dedup": line_dedup.OP6_SQL,
    "op8_quality_rules": quality_rules.OP8_SQL,
    "op11_importance_resampling": importance.OP11_SQL,
    "op12_centroid_clustering": centroids.OP12_SQL,
}
