"""The registered queries of the package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.llm import (
    alignment, chat, decontaminate, jaccard, merkle, oracles, packing, pii, quality, repeats, rules, secrets, token_files, warc,
)
from larder.session import tune


def _tuned(fn: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(tune(spark), sf_dir.rstrip("/"))


QUERIES = {
    f.__name__: _tuned(f)
    for f in (
        secrets.op1_secrets,
        decontaminate.op2_decontamination,
        packing.op3_packing,
        token_files.op4_token_files,
        rules.op5_quality_rules,
        jaccard.op6_ngram_jaccard,
        repeats.op7_repeated_passages,
        warc.op8_warc,
        quality.op9_quality_classifier,
        pii.op10_pii,
        chat.op11_chat_formatting,
        merkle.op12_merkle_manifest,
        alignment.op13_token_alignment,
    )
}
ORACLES: dict[str, str] = {
    "op2_decontamination": oracles.DECONTAMINATION,
    "op5_quality_rules": oracles.QUALITY_RULES,
    "op6_ngram_jaccard": oracles.NGRAM_JACCARD,
    "op8_warc": oracles.WARC,
    "op11_chat_formatting": oracles.CHAT_FORMATTING,
    "op12_merkle_manifest": oracles.MERKLE,
}
