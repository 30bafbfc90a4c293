"""Queries of the training-data operators, (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from domus.llm import clusters, oracles, phrases
from domus.llm.bpe import op5_bpe
from domus.llm.clusters import op12_clusters
from domus.llm.decontaminate import op10_decontaminate
from domus.llm.fingerprints import op13_fingerprints
from domus.llm.jaccard import op9_jaccard
from domus.llm.language import op3_language
from domus.llm.licenses import op7_licenses
from domus.llm.phrases import op11_phrases
from domus.llm.secrets import op4_secrets
from domus.llm.substrings import op2_substrings
from domus.llm.suffixes import op8_suffixes
from domus.llm.token_files import op6_token_files
from domus.llm.topk import op1_topk



def base_secrets(spark, sf_dir):
    """The base spans of op4, which SQL can express."""
    return op4_secrets(spark, sf_dir).drop("spans")


def base_licenses(spark, sf_dir):
    """The base phrases of op7, which SQL can express."""
    return op7_licenses(spark, sf_dir).drop("labels", "score")


QUERIES = {q.__name__: q for q in (
    op1_topk, op2_substrings, op3_language, op4_secrets, op5_bpe, op6_token_files, op7_licenses, op8_suffixes, op9_jaccard,
    op10_decontaminate, op11_phrases, op12_clusters, op13_fingerprints, base_secrets, base_licenses)}

#: query name -> DuckDB SQL with the same rows
ORACLES = {"op1_topk": oracles.TOPK, "op2_substrings": oracles.SUBSTRINGS, "op9_jaccard": oracles.JACCARD, "op10_decontaminate": oracles.DECONTAMINATE,
           "op11_phrases": phrases.ORACLE, "op12_clusters": clusters.ORACLE, "base_secrets": oracles.SECRETS, "base_licenses": oracles.LICENSES}
