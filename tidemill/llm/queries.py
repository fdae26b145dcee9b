"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.bpe_count import op10_bpe_token_counts
from tidemill.llm.decontaminate import OP3_SQL, op3_decontamination
from tidemill.llm.dialogue_repair import OP13_SQL, op13_dialogue_repair
from tidemill.llm.edit_embedding import near_fingerprints, op1_edit_embedding
from tidemill.llm.licenses import op6_licenses, op6_sql
from tidemill.llm.mixing import op12_mixing, op12_sql
from tidemill.llm.ngram_join import OP9_SQL, op9_ngram_join
from tidemill.llm.packing import op7_packing
from tidemill.llm.quality import op8_quality
from tidemill.llm.ranked_search import OP11_SQL, op11_ranked_search
from tidemill.llm.secrets import OP2_SQL, op2_secrets
from tidemill.llm.substring_dedup import OP4_SQL, op4_substring_dedup
from tidemill.llm.toxicity import op5_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_edit_embedding, op2_secrets, op3_decontamination, op4_substring_dedup, op5_toxicity, op6_licenses, op7_packing, op8_quality, op9_ngram_join, op10_bpe_token_counts, op11_ranked_search, op12_mixing, op13_dialogue_repair, near_fingerprints)}


def oracle_sql() -> dict[str, str]:
    return {"op2_secrets": OP2_SQL, "op3_decontamination": OP3_SQL, "op4_substring_dedup": OP4_SQL, "op6_licenses": op6_sql(), "op9_ngram_join": OP9_SQL, "op11_ranked_search": OP11_SQL, "op12_mixing": op12_sql(), "op13_dialogue_repair": OP13_SQL}
