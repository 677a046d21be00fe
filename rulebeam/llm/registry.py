"""Queries of the subpackage and their SQL."""

from __future__ import annotations

from .conversation_repair import op13_conversation_repair, op13_sql
from .decontaminate import OP4_SQL, op4_benchmark_decontamination
from .html_text import op3_html_extraction
from .language import op6_language_id
from .licenses import op8_license_scan, op8_sql
from .line_dedup import op1_line_dedup
from .merkle import op12_merkle_manifest, op12_sql
from .neighbors import op2_nearest_neighbours
from .packing import op7_packing
from .quality import op10_quality_classifier
from .secret_scan import op11_secret_scan, op11_sql
from .simhash import op9_simhash_near_dedup
from .token_counts import op5_token_counts


def all_queries() -> dict:
    import corpus_pipeline
    return {
        "pipeline": corpus_pipeline.run,
        "op1_line_dedup": op1_line_dedup,
        "op2_nearest_neighbours": op2_nearest_neighbours,
        "op3_html_extraction": op3_html_extraction,
        "op4_benchmark_decontamination": op4_benchmark_decontamination,
        "op5_token_counts": op5_token_counts,
        "op6_language_id": op6_language_id,
        "op7_packing": op7_packing,
        "op8_license_scan": op8_license_scan,
        "op9_simhash_near_dedup": op9_simhash_near_dedup,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_secret_scan": op11_secret_scan,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_conversation_repair": op13_conversation_repair,
    }


def all_sql() -> dict[str, str]:
    import corpus_pipeline
    sql = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return sql | {
        "op4_benchmark_decontamination": OP4_SQL,
        "op8_license_scan": op8_sql(),
        "op11_secret_scan": op11_sql(),
        "op12_merkle_manifest": op12_sql(),
        "op13_conversation_repair": op13_sql(),
    }
