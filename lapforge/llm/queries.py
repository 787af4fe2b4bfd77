"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lapforge.llm.alignment import op12_alignment
from lapforge.llm.decontamination import OP7_SQL, op7_decontamination
from lapforge.llm.exact_dedup import OP10_SQL, op10_exact_dedup
from lapforge.llm.language import op9_language
from lapforge.llm.line_dedup import OP2_SQL, op2_line_dedup
from lapforge.llm.ngram_join import OP3_SQL, op3_ngram_join
from lapforge.llm.packing import op1_packing
from lapforge.llm.periods import op13_periodic_runs
from lapforge.llm.quality import op8_quality
from lapforge.llm.secrets import op6_secrets
from lapforge.llm.toxicity import op5_toxicity
from lapforge.llm.url_filter import OP11_SQL, op11_url_filter
from lapforge.llm.warc import OP4_SQL, op4_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_packing, op2_line_dedup, op3_ngram_join, op4_warc, op5_toxicity, op6_secrets,
        op7_decontamination, op8_quality, op9_language, op10_exact_dedup,
        op11_url_filter, op12_alignment, op13_periodic_runs)
}

ORACLE: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op3_ngram_join": OP3_SQL,
    "op4_warc": OP4_SQL,
    "op7_decontamination": OP7_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op11_url_filter": OP11_SQL,
}
