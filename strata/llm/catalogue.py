"""The operators' queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe, chat, fingerprint, jaccard, language, lexical, mixing, pii, runs, secrets, sharding, tokenfile, topk

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_pii": pii.op1_pii,
        "op2_mixing": mixing.op2_mixing,
        "op3_jaccard": jaccard.op3_jaccard,
        "op4_fingerprint": fingerprint.op4_fingerprint,
        "op5_chat": chat.op5_chat,
        "op6_bpe": bpe.op6_bpe,
        "op7_sharding": sharding.op7_sharding,
        "op8_secrets": secrets.op8_secrets,
        "op9_language": language.op9_language,
        "op10_topk": topk.op10_topk,
        "op11_lexical": lexical.op11_lexical,
        "op12_tokenfile": tokenfile.op12_tokenfile,
        "op13_runs": runs.op13_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mixing": mixing.SQL,
        "op3_jaccard": jaccard.SQL,
        "op5_chat": chat.SQL,
        "op8_secrets": secrets.SQL,
        "op10_topk": topk.SQL,
        "op11_lexical": lexical.SQL,
    }
