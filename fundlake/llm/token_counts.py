"""Token counts with the whole-token shortcut.

Before the run, every vocabulary string is tried alone: those that the splitter keeps in one piece and the merges turn
into exactly one token are proven. In a text a proven pre-token counts one without being merged; only the rest is merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import filterfalse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import pick, read, rows_of
from fundlake.llm.tokens import PieceTokenizer, byte_letters, tokenizer


def proven_whole(words: PieceTokenizer) -> frozenset[str]:
    """Vocabulary strings that, standing alone as a pre-token, are one token. Bounded by the vocabulary."""
    letters, candidates = {letter: byte for byte, letter in enumerate(byte_letters())}, []
    for token in words.vocabulary:
        if words.word_end and not token.endswith(words.word_end):
            continue
        token = token.removesuffix(words.word_end)
        try:
            text = bytes(letters[letter] for letter in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if text and words.pieces(text) == [text]:
            candidates.append(text)
    encoded = words.library.encode_batch_fast(candidates, add_special_tokens=False)
    return frozenset(text for text, tokens in zip(candidates, encoded, strict=True) if len(tokens.ids) == 1)


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``) of every whole text.

    A null text counts as empty: 0 bytes, 0 tokens. Rows repeat in the result as often as in the input; a null id stays
    null; further columns are not read. There is no shuffle: each text is counted where it is read.
    """
    spark = docs.sparkSession
    whole = spark.sparkContext.broadcast(proven_whole(tokenizer(tokenizer_path)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, proven = tokenizer(tokenizer_path), whole.value.__contains__
        for batch in batches:
            sizes, counts = [], []
            for (text,) in rows_of(batch, "text"):
                text = text or ""
                sizes.append(len(text.encode()))
                if (pieces := words.pieces(text)) is None:
                    counts.append(len(words.library.encode(text, add_special_tokens=False).ids))
                else:
                    rest = list(filterfalse(proven, pieces))
                    counts.append(len(pieces) - len(rest) + sum(map(len, map(words.ids.__getitem__, rest))) // 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = source.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents", doc_id="long", text="string")
    return pick(
        count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")),
        doc_id="long", n_bytes="long", n_tokens="long", over_limit="boolean",
    )
