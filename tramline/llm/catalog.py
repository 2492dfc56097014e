"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from .embeddings import ORACLE_SQL as EMBEDDINGS_SQL
from .embeddings import op4_embeddings
from .language import op8_language
from .language_model import op2_language_model
from .minhash import ORACLE_SQL as MINHASH_SQL
from .minhash import op7_minhash
from .mixing import op6_mixing
from .packing import op10_packing
from .quality import ORACLE_SQL as QUALITY_SQL
from .quality import op1_quality
from .sharding import ORACLE_SQL as SHARDING_SQL
from .sharding import op5_sharding
from .suffix import ORACLE_SQL as SUFFIX_SQL
from .suffix import op3_suffix
from .urls import op9_urls


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_language_model": op2_language_model,
        "op3_suffix": op3_suffix,
        "op4_embeddings": op4_embeddings,
        "op5_sharding": op5_sharding,
        "op6_mixing": op6_mixing,
        "op7_minhash": op7_minhash,
        "op8_language": op8_language,
        "op9_urls": op9_urls,
        "op10_packing": op10_packing,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    """Models, schedules and packing are not expressed in SQL."""
    return {"op1_quality": QUALITY_SQL, "op3_suffix": SUFFIX_SQL, "op4_embeddings": EMBEDDINGS_SQL, "op5_sharding": SHARDING_SQL, "op7_minhash": MINHASH_SQL}
