"""The queries of this subpackage, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimforge.llm import bpe, chats, decontaminate, exact_dedup, jaccard_join, languages, licenses, line_quality, merkle, resampling, secrets, token_files, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": secrets.op1_secret_scan,
        "op2_token_files": token_files.op2_token_files,
        "op3_license_scan": licenses.op3_license_scan,
        "op4_exact_dedup": exact_dedup.op4_exact_dedup,
        "op5_chat_format": chats.op5_chat_format,
        "op6_warc": warc.op6_warc,
        "op7_language_id": languages.op7_language_id,
        "op8_jaccard_join": jaccard_join.op8_jaccard_join,
        "op9_bpe": bpe.op9_bpe,
        "op10_decontaminate": decontaminate.op10_decontaminate,
        "op11_resample": resampling.op11_resample,
        "op12_line_quality": line_quality.op12_line_quality,
        "op13_merkle": merkle.op13_merkle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_dedup": exact_dedup.OP4_SQL,
        "op5_chat_format": chats.OP5_SQL,
        "op6_warc": warc.OP6_SQL,
        "op10_decontaminate": decontaminate.OP10_SQL,
        "op11_resample": resampling.OP11_SQL,
        "op12_line_quality": line_quality.OP12_SQL,
        "op13_merkle": merkle.OP13_SQL,
    }
