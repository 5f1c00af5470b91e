"""The registered queries of this subpackage, and the SQL that checks them where SQL can."""

from __future__ import annotations

from petrel.llm.bpe import op8_byte_bpe
from petrel.llm.chat import op3_chat_format
from petrel.llm.decontaminate import op7_benchmark_decontamination
from petrel.llm.jaccard import op6_jaccard_join
from petrel.llm.licenses import op1_license_scan
from petrel.llm.lines import op11_line_dedup
from petrel.llm.oracles import ORACLES  # noqa: F401
from petrel.llm.pii import op9_pii
from petrel.llm.quality import op4_quality_rules
from petrel.llm.resample import op12_importance_resampling
from petrel.llm.secrets import op5_secret_scan
from petrel.llm.substrings import op2_substring_dedup
from petrel.llm.toxicity import op10_toxicity

QUERIES = {f.__name__: f for f in (op1_license_scan, op2_substring_dedup, op3_chat_format, op4_quality_rules, op5_secret_scan, op6_jaccard_join, op7_benchmark_decontamination, op8_byte_bpe, op9_pii, op10_toxicity, op11_line_dedup, op12_importance_resampling)}
