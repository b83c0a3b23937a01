"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import op6_exact_dedup as op6
from . import op7_sharding as op7
from . import op10_warc as op10
from . import op11_embedding_dedup as op11
from . import op12_spelling as op12
from . import op13_lexical_search as op13
from .op1_token_counts import op1_token_counts
from .op2_bpe_codec import op2_bpe_codec
from .op3_packing import op3_packing
from .op4_fingerprints import op4_fingerprints
from .op5_language import op5_language
from .op8_lm_scoring import op8_lm_scoring
from .op9_near_dedup import op9_near_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_packing": op3_packing,
    "op4_fingerprints": op4_fingerprints,
    "op5_language": op5_language,
    "op6_exact_dedup": op6.op6_exact_dedup,
    "op7_sharding": op7.op7_sharding,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_near_dedup": op9_near_dedup,
    "op10_warc": op10.op10_warc,
    "op11_embedding_dedup": op11.op11_embedding_dedup,
    "op12_spelling": op12.op12_spelling,
    "op13_lexical_search": op13.op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {"op6_exact_dedup": op6.ORACLE, "op7_sharding": op7.ORACLE, "op10_warc": op10.ORACLE, "op11_embedding_dedup": op11.ORACLE, "op12_spelling": op12.ORACLE, "op13_lexical_search": op13.ORACLE}
