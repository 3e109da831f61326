"""The registered queries of this subpackage, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op4_bpe_encoding
from .conversations import OP11_SQL, op11_conversation_repair
from .decontaminate import OP10_SQL, op10_decontamination
from .jaccard_join import OP9_SQL, op9_jaccard_join
from .licences import OP1_SQL, op1_licence_scan
from .lm_scoring import op7_lm_scoring
from .merkle import OP12_SQL, op12_merkle_manifest
from .packing import op13_packing
from .quality import OP6_SQL, op6_quality_rules
from .sharding import op8_sharding
from .token_counts import op5_token_counts
from .toxicity import op2_toxicity
from .url_filter import OP3_SQL, op3_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licence_scan": op1_licence_scan,
    "op2_toxicity": op2_toxicity,
    "op3_url_filter": op3_url_filter,
    "op4_bpe_encoding": op4_bpe_encoding,
    "op5_token_counts": op5_token_counts,
    "op6_quality_rules": op6_quality_rules,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_sharding": op8_sharding,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_decontamination": op10_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_packing": op13_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op1_licence_scan": OP1_SQL,
    "op3_url_filter": OP3_SQL,
    "op6_quality_rules": OP6_SQL,
    "op9_jaccard_join": OP9_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
