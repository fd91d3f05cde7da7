"""The queries of this subpackage, by name, and DuckDB SQL for those that have it."""

from __future__ import annotations

from quillmill.llm import clustering, decontamination, language_model, lexical_search, licenses, packing, pipeline, quality_classifier, quality_rules, secrets, sharding, simhash, substrings, warc

QUERIES = {
    f.__name__: f
    for f in (
        packing.op1_best_fit_packing, quality_rules.op2_quality_rules, secrets.op3_secret_scans, substrings.op4_substring_dedup, quality_classifier.op5_quality_classifier,
        warc.op6_warc, simhash.op7_simhash_near_dedup, licenses.op8_license_scans, language_model.op9_lm_scoring, decontamination.op10_benchmark_decontamination,
        clustering.op11_centroid_clustering, lexical_search.op12_ranked_lexical_search, sharding.op13_sharding,
    )
} | {"pipeline": pipeline.run}

ORACLE_SQL = {"op4_substring_dedup": substrings.OP4_SQL, "op6_warc": warc.OP6_SQL, "op8_license_scans": licenses.OP8_SQL, "op11_centroid_clustering": clustering.OP11_SQL, "op12_ranked_lexical_search": lexical_search.OP12_SQL, "op13_sharding": sharding.OP13_SQL}
if pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = pipeline.ORACLE_SQL
