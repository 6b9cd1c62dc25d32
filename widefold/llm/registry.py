"""The registered queries of the text operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from widefold.llm import (
    alignment,
    decontaminate,
    exact_dedup,
    html_extract,
    language_id,
    licenses,
    line_dedup,
    packing,
    prefix_tree,
    quotations,
    secrets,
    simhash,
    suffix_dedup,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": exact_dedup.query,
        "op2_line_dedup": line_dedup.query,
        "op3_packing": packing.query,
        "op4_decontamination": decontaminate.query,
        "op5_html_extraction": html_extract.query,
        "op6_quotation_linking": quotations.query,
        "op7_secret_scan": secrets.query,
        "op8_language_id": language_id.query,
        "op9_license_scan": licenses.query,
        "op10_simhash": simhash.query,
        "op11_alignment": alignment.query,
        "op12_suffix_dedup": suffix_dedup.query,
        "op13_prefix_tree": prefix_tree.query,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": exact_dedup.ORACLE_SQL, "op2_line_dedup": line_dedup.ORACLE_SQL,
            "op6_quotation_linking": quotations.ORACLE_SQL, "op13_prefix_tree": prefix_tree.ORACLE_SQL}
