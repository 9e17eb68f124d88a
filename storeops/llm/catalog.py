"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from storeops.llm.bpe import op8_bpe
from storeops.llm.decontaminate import op7_decontaminate
from storeops.llm.lexical import OP12_SQL, op12_lexical
from storeops.llm.licences import op10_licences
from storeops.llm.maintext import op13_maintext
from storeops.llm.minhash import op2_minhash
from storeops.llm.quality import op9_quality
from storeops.llm.secrets import OP5_SQL, op5_secrets
from storeops.llm.simhash import op6_simhash
from storeops.llm.tokencount import op3_token_counts
from storeops.llm.toxicity import op4_toxicity
from storeops.llm.trie import OP11_SQL, op11_trie
from storeops.llm.warc import OP1_SQL, op1_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_minhash": op2_minhash,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_secrets": op5_secrets,
    "op6_simhash": op6_simhash,
    "op7_decontaminate": op7_decontaminate,
    "op8_bpe": op8_bpe,
    "op9_quality": op9_quality,
    "op10_licences": op10_licences,
    "op11_trie": op11_trie,
    "op12_lexical": op12_lexical,
    "op13_maintext": op13_maintext,
}

ORACLE: dict[str, str] = {"op1_warc": OP1_SQL, "op5_secrets": OP5_SQL, "op11_trie": OP11_SQL, "op12_lexical": OP12_SQL}
