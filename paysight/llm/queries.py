"""The queries of this subpackage and, where SQL can express one, its DuckDB text."""

from __future__ import annotations

import corpus_pipeline

from .collocations import OP12_SQL, op12_collocations
from .decontaminate import OP8_SQL, op8_benchmark_decontamination
from .exact_dedup import OP11_SQL, op11_exact_dedup
from .langid import op1_language_id
from .licenses import OP3_SQL, op3_license_scan
from .lm import op4_lm_scoring
from .packing import op6_best_fit_packing
from .quality import op2_quality_classifier
from .secrets import op9_secret_scan
from .simhash import op7_simhash_dedup
from .token_counts import op5_token_counts
from .topk import OP10_SQL, op10_topk_search
from .vector_codes import OP13_SQL, op13_vector_codes

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_license_scan": op3_license_scan,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_token_counts": op5_token_counts,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_secret_scan": op9_secret_scan,
    "op10_topk_search": op10_topk_search,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_collocations": op12_collocations,
    "op13_vector_codes": op13_vector_codes,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op3_license_scan": OP3_SQL,
    "op8_benchmark_decontamination": OP8_SQL,
    "op10_topk_search": OP10_SQL,
    "op11_exact_dedup": OP11_SQL,
    "op12_collocations": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
}
