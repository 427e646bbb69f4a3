"""Registered queries of the subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat,
    decontaminate,
    html_text,
    ngram_join,
    packing,
    phrases,
    quality,
    sharding,
    substring_dedup,
    suffix_dedup,
    token_alignment,
    url_filter,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_string_tiling": decontaminate.op2_string_tiling,
    "op3_window_dedup": substring_dedup.op3_window_dedup,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_best_fit": packing.op5_best_fit,
    "op6_adaptive_rules": quality.op6_adaptive_rules,
    "op7_jump_shards": sharding.op7_jump_shards,
    "op8_layout_text": html_text.op8_layout_text,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_chat_snapshots": chat.op10_chat_snapshots,
    "op11_gzip_members": warc.op11_gzip_members,
    "op12_run_skipping": token_alignment.op12_run_skipping,
    "op13_phrases": phrases.op13_phrases,
}

ORACLE: dict[str, str] = {
    "op10_chat_snapshots": chat.OP10_SQL,
    "op11_gzip_members": warc.OP11_SQL,
    "op13_phrases": phrases.OP13_SQL,
}
