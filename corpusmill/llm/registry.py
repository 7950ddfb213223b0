"""The subpackage's queries and their SQL, where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from corpusmill.llm import bpe, jpeg, language, mixing, simhash, suffix_dedup, token_counts, toxicity, url_filter, vectors


def queries() -> dict:
    return {
        "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_int8_tiles": vectors.op3_int8_tiles,
        "op4_url_filter": url_filter.op4_url_filter,
        "op5_simhash": simhash.op5_simhash,
        "op6_mixing": mixing.op6_mixing,
        "op7_bpe": bpe.op7_bpe,
        "op8_language": language.op8_language,
        "op9_jpeg_media": jpeg.op9_jpeg_media,
        "op10_token_counts": token_counts.op10_token_counts,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_int8_tiles": vectors.ORACLE_SQL, "op4_url_filter": url_filter.ORACLE_SQL, "op6_mixing": mixing.ORACLE_SQL}
