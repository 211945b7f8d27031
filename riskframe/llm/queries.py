"""One query per operator, over whole tables; SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm.counts import op6_token_counts
from riskframe.llm.fingerprints import op2_document_fingerprints
from riskframe.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from riskframe.llm.language import op9_language_id
from riskframe.llm.lines import op10_line_dedup
from riskframe.llm.mixing import op5_soft_mixing
from riskframe.llm.near_dups import op8_minhash_near_dedup
from riskframe.llm.neighbours import op7_nearest_neighbours
from riskframe.llm.packing import op3_best_fit_packing
from riskframe.llm.quality import op1_quality_classifier
from riskframe.llm.tries import OP11_SQL, op11_conversation_trie
from riskframe.llm.urls import op4_url_filters
from riskframe.llm.vector_dups import OP12_SQL, op12_embedding_near_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_classifier, op2_document_fingerprints, op3_best_fit_packing,
                                     op4_url_filters, op5_soft_mixing, op6_token_counts, op7_nearest_neighbours,
                                     op8_minhash_near_dedup, op9_language_id, op10_line_dedup, op11_conversation_trie,
                                     op12_embedding_near_dedup, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op11_conversation_trie": OP11_SQL, "op12_embedding_near_dedup": OP12_SQL, "op13_hard_negatives": OP13_SQL}
