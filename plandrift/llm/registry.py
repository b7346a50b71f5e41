"""The package's queries for the driver, with their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plandrift.llm.cap_filters import op6_near_vectors
from plandrift.llm.decontamination import ORACLE as DECONTAMINATION_SQL
from plandrift.llm.decontamination import op13_decontamination
from plandrift.llm.filter_audit import ORACLE as AUDIT_SQL
from plandrift.llm.filter_audit import op12_filter_audit
from plandrift.llm.html_text import op5_html_text
from plandrift.llm.language_model import op1_lm_scores
from plandrift.llm.packing import op10_packing
from plandrift.llm.phrases import ORACLE as PHRASES_SQL
from plandrift.llm.phrases import op11_phrases
from plandrift.llm.piece_transducer import op2_sentencepiece
from plandrift.llm.quality_classifier import op7_quality_classifier
from plandrift.llm.quality_rules import op8_quality_rules
from plandrift.llm.secret_scan import ORACLE as SECRETS_SQL
from plandrift.llm.secret_scan import op4_secrets
from plandrift.llm.simhash import op9_simhash
from plandrift.llm.token_counts import op3_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_lm_scores, op2_sentencepiece, op3_token_counts, op4_secrets, op5_html_text, op6_near_vectors,
    op7_quality_classifier, op8_quality_rules, op9_simhash, op10_packing,
    op11_phrases, op12_filter_audit, op13_decontamination)}

ORACLES: dict[str, str] = {"op4_secrets": SECRETS_SQL, "op11_phrases": PHRASES_SQL,
                           "op12_filter_audit": AUDIT_SQL, "op13_decontamination": DECONTAMINATION_SQL}
