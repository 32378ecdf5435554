"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .exact import OP4_SQL, op4_exact_dedup
from .jaccard import op12_jaccard_join
from .kmeans import op13_clusters
from .langid import op5_language
from .mix import op1_mix_sources
from .pack import op3_pack
from .quality import op2_quality
from .search import OP11_SQL, op11_search
from .shard import op9_shard
from .simhash import op10_simhash
from .spots import op7_fingerprints
from .substrings import op8_substring_dedup
from .tokens import op6_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_quality,
        op3_pack,
        op4_exact_dedup,
        op5_language,
        op6_token_counts,
        op7_fingerprints,
        op8_substring_dedup,
        op9_shard,
        op10_simhash,
        op11_search,
        op12_jaccard_join,
        op13_clusters,
    )
}

ORACLE_SQL: dict[str, str] = {"op4_exact_dedup": OP4_SQL, "op11_search": OP11_SQL}
