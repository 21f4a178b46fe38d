"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.llm.ann import op1_nearest_neighbours
from marquee.llm.chat import op7_chat_formatting
from marquee.llm.decontaminate import op2_decontamination
from marquee.llm.jaccard import op13_jaccard_join
from marquee.llm.langid import op6_language_id
from marquee.llm.merkle import op11_merkle_manifest
from marquee.llm.mixing import op5_mixing
from marquee.llm.oracles import ORACLES
from marquee.llm.phrases import op12_phrase_collocations
from marquee.llm.quality import op9_quality_classifier
from marquee.llm.sharding import op3_sharding
from marquee.llm.simhash import op8_simhash_near_dedup
from marquee.llm.substrings import op4_suffix_array_dedup
from marquee.llm.toxicity import op10_toxicity

_QUERIES = (op1_nearest_neighbours, op2_decontamination, op3_sharding, op4_suffix_array_dedup,
            op5_mixing, op6_language_id, op7_chat_formatting, op8_simhash_near_dedup,
            op9_quality_classifier, op10_toxicity, op11_merkle_manifest,
            op12_phrase_collocations, op13_jaccard_join)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline
    return {q.__name__: q for q in _QUERIES} | {"pipeline": corpus_pipeline.run}


def llm_oracles() -> dict[str, str]:
    """DuckDB SQL, where SQL can express a query.  The others hold seeded hashes of Spark, trained
    models or graph searches; they are tested against brute force, round trips or held-out
    accuracy in ``tests/llm``."""
    import corpus_pipeline
    out = dict(ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
