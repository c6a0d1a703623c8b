"""The queries of this subpackage, by name, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from termloom.llm.fingerprint import op5_fingerprint
from termloom.llm.language import op10_language
from termloom.llm.lm import op1_lm
from termloom.llm.manifest import OP13_SQL, op13_manifest
from termloom.llm.minhash import op4_minhash
from termloom.llm.packing import op7_packing
from termloom.llm.private import op11_private
from termloom.llm.repeats import op2_repeats
from termloom.llm.runs import op12_runs
from termloom.llm.sampling import op6_sampling
from termloom.llm.shards import op3_shards
from termloom.llm.topk import OP8_SQL, op8_topk
from termloom.llm.toxicity import op9_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm": op1_lm,
    "op2_repeats": op2_repeats,
    "op3_shards": op3_shards,
    "op4_minhash": op4_minhash,
    "op5_fingerprint": op5_fingerprint,
    "op6_sampling": op6_sampling,
    "op7_packing": op7_packing,
    "op8_topk": op8_topk,
    "op9_toxicity": op9_toxicity,
    "op10_language": op10_language,
    "op11_private": op11_private,
    "op12_runs": op12_runs,
    "op13_manifest": op13_manifest,
}

SQL: dict[str, str] = {"op8_topk": OP8_SQL, "op13_manifest": OP13_SQL}
