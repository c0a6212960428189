"""Queries over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from layerkit.llm.centroids import OP12_SQL, op12_centroid_clustering
from layerkit.llm.chat import OP8_SQL, op8_chat_format
from layerkit.llm.exact_dedup import OP3_SQL, op3_exact_dedup
from layerkit.llm.jaccard import op10_ngram_jaccard_join
from layerkit.llm.language_id import op6_language_id
from layerkit.llm.mixing import OP1_SQL, op1_mixing
from layerkit.llm.negatives import OP11_SQL, op11_hard_negatives
from layerkit.llm.packing import op5_packing
from layerkit.llm.quality_model import op9_quality_model
from layerkit.llm.quality_rules import op7_quality_rules
from layerkit.llm.secrets import op4_secret_scan
from layerkit.llm.sharding import op2_sharding
from layerkit.llm.toxicity import op13_toxicity

_OPERATORS = (
    op1_mixing,
    op2_sharding,
    op3_exact_dedup,
    op4_secret_scan,
    op5_packing,
    op6_language_id,
    op7_quality_rules,
    op8_chat_format,
    op9_quality_model,
    op10_ngram_jaccard_join,
    op11_hard_negatives,
    op12_centroid_clustering,
    op13_toxicity,
)
QUERIES = {operator.__name__: operator for operator in _OPERATORS}
ORACLES = {"op1_mixing": OP1_SQL, "op3_exact_dedup": OP3_SQL, "op8_chat_format": OP8_SQL, "op11_hard_negatives": OP11_SQL, "op12_centroid_clustering": OP12_SQL}
