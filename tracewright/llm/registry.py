"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .curriculum_mix import OP5_SQL, op5_curriculum_mix
from .decontaminate import op7_decontaminate
from .html_text import op2_html_text
from .importance import op10_importance_classifier
from .jaccard_join import op8_jaccard_join
from .lm_score import op4_lm_score
from .quality_rules import OP1_SQL, op1_quality_rules
from .secret_scan import OP3_SQL, op3_secret_scan
from .token_counts import op9_token_counts
from .warc import OP6_SQL, op6_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_html_text": op2_html_text,
    "op3_secret_scan": op3_secret_scan,
    "op4_lm_score": op4_lm_score,
    "op5_curriculum_mix": op5_curriculum_mix,
    "op6_warc": op6_warc,
    "op7_decontaminate": op7_decontaminate,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_token_counts": op9_token_counts,
    "op10_importance_classifier": op10_importance_classifier,
}

ORACLES: dict[str, str] = {
    "op1_quality_rules": OP1_SQL,
    "op3_secret_scan": OP3_SQL,
    "op5_curriculum_mix": OP5_SQL,
    "op6_warc": OP6_SQL,
}
