"""The registered queries of this subpackage: name to function of (spark, folder), and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.alignment import op12_token_alignment
from tidemark.llm.bpe import op11_byte_bpe
from tidemark.llm.brown import op1_brown_scores
from tidemark.llm.chat import op7_chat_formatting
from tidemark.llm.decontamination import ORACLE_SQL as DECONTAMINATION_SQL
from tidemark.llm.decontamination import op10_decontamination
from tidemark.llm.fmindex import op2_fm_index
from tidemark.llm.language import op3_language_id
from tidemark.llm.phrases import ORACLE_SQL as PHRASES_SQL
from tidemark.llm.phrases import op13_phrases
from tidemark.llm.pieces import op8_sentencepiece
from tidemark.llm.quality import op9_quality_rules
from tidemark.llm.simhash import op4_simhash
from tidemark.llm.suffixes import op5_suffix_array
from tidemark.llm.tables import ship
from tidemark.llm.warc import ORACLE_SQL as WARC_SQL
from tidemark.llm.warc import op6_warc

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


REGISTRY: dict[str, Query] = {
    "op1_brown_scores": _shipped(op1_brown_scores),
    "op2_fm_index": _shipped(op2_fm_index),
    "op3_language_id": _shipped(op3_language_id),
    "op4_simhash": _shipped(op4_simhash),
    "op5_suffix_array": _shipped(op5_suffix_array),
    "op6_warc": _shipped(op6_warc),
    "op7_chat_formatting": _shipped(op7_chat_formatting),
    "op8_sentencepiece": _shipped(op8_sentencepiece),
    "op9_quality_rules": _shipped(op9_quality_rules),
    "op10_decontamination": _shipped(op10_decontamination),
    "op11_byte_bpe": _shipped(op11_byte_bpe),
    "op12_token_alignment": _shipped(op12_token_alignment),
    "op13_phrases": _shipped(op13_phrases),
}

ORACLE: dict[str, str] = {"op10_decontamination": DECONTAMINATION_SQL, "op6_warc": WARC_SQL, "op13_phrases": PHRASES_SQL}
