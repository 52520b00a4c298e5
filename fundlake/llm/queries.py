"""The operators as queries over whole tables, and the SQL that gives the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundlake.llm.conversations import SQL as CONVERSATIONS_SQL
from fundlake.llm.conversations import op13_conversations
from fundlake.llm.decontaminate import op5_decontaminate
from fundlake.llm.html_text import op8_html_text
from fundlake.llm.language import op4_language
from fundlake.llm.merkle import SQL as MERKLE_SQL
from fundlake.llm.merkle import op11_merkle
from fundlake.llm.neighbours import op7_neighbours
from fundlake.llm.ngram_join import SQL as NGRAM_SQL
from fundlake.llm.ngram_join import op1_ngram_join
from fundlake.llm.packing import op6_packing
from fundlake.llm.quality import op10_quality
from fundlake.llm.rules import op12_rules
from fundlake.llm.substrings import SQL as SUBSTRINGS_SQL
from fundlake.llm.substrings import op3_substrings
from fundlake.llm.token_counts import op9_token_counts
from fundlake.llm.warc import SQL as WARC_SQL
from fundlake.llm.warc import op2_warc

ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_warc": op2_warc,
    "op3_substrings": op3_substrings,
    "op4_language": op4_language,
    "op5_decontaminate": op5_decontaminate,
    "op6_packing": op6_packing,
    "op7_neighbours": op7_neighbours,
    "op8_html_text": op8_html_text,
    "op9_token_counts": op9_token_counts,
    "op10_quality": op10_quality,
    "op11_merkle": op11_merkle,
    "op12_rules": op12_rules,
    "op13_conversations": op13_conversations,
}

SQL: dict[str, str] = {
    "op1_ngram_join": NGRAM_SQL,
    "op2_warc": WARC_SQL,
    "op3_substrings": SUBSTRINGS_SQL,
    "op11_merkle": MERKLE_SQL,
    "op13_conversations": CONVERSATIONS_SQL,
}
