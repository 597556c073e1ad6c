"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from etalage.llm import contract_sql
from etalage.llm.contamination import contamination_query
from etalage.llm.line_dedup import line_dedup_query
from etalage.llm.merkle import manifest_query
from etalage.llm.packing import packing_query
from etalage.llm.quality import quality_query
from etalage.llm.sharding import sharding_query
from etalage.llm.simhash import simhash_query
from etalage.llm.substring_dedup import substring_query
from etalage.llm.suffix_dedup import suffix_query
from etalage.llm.token_counts import token_query
from etalage.llm.url_filters import url_query
from etalage.llm.warc import warc_query
from etalage.llm.word_runs import word_runs_query


def queries() -> dict:
    return {
        "op1_token_counts": token_query,
        "op2_url_filters": url_query,
        "op3_decontamination": contamination_query,
        "op4_line_dedup": line_dedup_query,
        "op5_sharding": sharding_query,
        "op6_packing": packing_query,
        "op7_warc": warc_query,
        "op8_suffix_dedup": suffix_query,
        "op9_quality_rules": quality_query,
        "op10_simhash": simhash_query,
        "op11_word_runs": word_runs_query,
        "op12_substring_dedup": substring_query,
        "op13_merkle_manifest": manifest_query,
    }


def oracle_sql() -> dict[str, str]:
    """Whole-table SQL; the other operators are compared with plain versions of their contracts in ``tests/llm``."""
    return {
        "op2_url_filters": contract_sql.URL_RULES,
        "op3_decontamination": contract_sql.CONTAMINATION,
        "op4_line_dedup": contract_sql.LINE_DEDUP,
        "op5_sharding": contract_sql.SHARDING,
        "op7_warc": contract_sql.ARCHIVE,
        "op8_suffix_dedup": contract_sql.REPEATED_BYTES,
        "op9_quality_rules": contract_sql.QUALITY,
        "op11_word_runs": contract_sql.WORD_RUNS,
        "op12_substring_dedup": contract_sql.SUBSTRINGS,
        "op13_merkle_manifest": contract_sql.MANIFEST,
    }
