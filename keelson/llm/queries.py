"""The queries of this package and their SQL, for ``__spark_entry__.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keelson.llm.centroids import ORACLE_SQL as CLUSTERS_SQL
from keelson.llm.centroids import op12_centroids
from keelson.llm.decontaminate import op9_decontaminate
from keelson.llm.exact_dedup import ORACLE_SQL as EQUAL_SQL
from keelson.llm.exact_dedup import op13_exact_dedup
from keelson.llm.filter_audit import ORACLE_SQL as AUDIT_SQL
from keelson.llm.filter_audit import op11_filter_audit
from keelson.llm.jaccard import ORACLE_SQL as JACCARD_SQL
from keelson.llm.jaccard import op2_jaccard_join
from keelson.llm.line_rules import ORACLE_SQL as RULES_SQL
from keelson.llm.line_rules import op8_line_rules
from keelson.llm.mixing import op5_mixing
from keelson.llm.pii import op3_pii
from keelson.llm.quality_crf import op10_quality_crf
from keelson.llm.substrings import ORACLE_SQL as REPEATS_SQL
from keelson.llm.substrings import op7_substring_dedup
from keelson.llm.tokens import op4_tokens
from keelson.llm.warc import op1_warc
from keelson.llm.wrappers import op6_main_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_pii": op3_pii,
    "op4_tokens": op4_tokens,
    "op5_mixing": op5_mixing,
    "op6_main_text": op6_main_text,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_line_rules": op8_line_rules,
    "op9_decontaminate": op9_decontaminate,
    "op10_quality_crf": op10_quality_crf,
    "op11_filter_audit": op11_filter_audit,
    "op12_centroids": op12_centroids,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op2_jaccard_join": JACCARD_SQL,
    "op7_substring_dedup": REPEATS_SQL,
    "op8_line_rules": RULES_SQL,
    "op11_filter_audit": AUDIT_SQL,
    "op12_centroids": CLUSTERS_SQL,
    "op13_exact_dedup": EQUAL_SQL,
}
