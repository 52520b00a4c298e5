"""Language identification by compression.

Every language has a raw-content dictionary for zstandard: texts of that language, from labelled rows. A text is
compressed with each dictionary, block by block, and belongs to the language whose dictionary makes it smallest. Where
the smallest and the next are close, in parts of the size and in bytes, it is compressed harder and with several
dictionaries of each language, whose sizes are added up. Where they still are close, the text is rejected: ``lang`` is ``und`` and only ``lang_pred`` has the best
guess.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlake.llm.common import read, rows_of
from fundlake.llm.quality import held_out

#: Per language: at most so many characters, from the first letter on, of at most this many labelled rows, dealt to so many dictionaries of at most
#: so many bytes.
SAMPLE_ROWS, SAMPLE_CHARS, DICTIONARIES, DICTIONARY_BYTES = 400, 4_000, 3, 96 * 1024
#: Texts are compressed in blocks of this many bytes, so that the dictionary and not the text's own start decides.
BLOCK = 2048
#: Compression levels of the first and the second look, and the margin under which there is a second one.
LEVEL, SECOND_LEVEL, SECOND_LOOK = 5, 12, 0.15
#: Bytes between the smallest and the next size from which on there is no second look: the score is 1 but for 1e-13 then. The
#: margin of a long text says little about it, as its bytes add up.
CERTAIN_BYTES = 64
#: What stands before the first letter, as Java's expressions have it.
_BEFORE_LETTERS = r"^[^\p{L}]+"
_HAS_LETTER = r"\p{L}"


def _kept(code: int) -> bool:
    """Letters, and marks that belong to letters."""
    return unicodedata.category(chr(code))[0] in "LM"


def _ranges(codes: Iterator[int]) -> str:
    """A character class of codes in order."""
    parts: list[list[int]] = []
    for code in codes:
        if parts and parts[-1][1] == code - 1:
            parts[-1][1] = code
        else:
            parts.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in parts)


#: Beyond the basic plane everything is kept first and looked at character by character; few texts have any of it.
_NOT_LETTERS = re.compile(f"[^{_ranges(code for code in range(0x10000) if _kept(code))}\U00010000-\U0010ffff]+")
_ASTRAL = re.compile("[\U00010000-\U0010ffff]+")
_LONE_MARKS = re.compile(r"[^\W\d_]")


def letters(text: str) -> str:
    """Lower-case words of a text, letters with their marks, with one space between them; empty if it has no letter.
    Digits, fractions, superscripts and number signs are no letters."""
    if text.isascii():
        return _NOT_LETTERS.sub(" ", text).strip().lower()
    words = _ASTRAL.sub(lambda run: "".join(c if _kept(ord(c)) else " " for c in run[0]), _NOT_LETTERS.sub(" ", text))
    words = " ".join(words.split())
    return words.lower() if _LONE_MARKS.search(words) else ""


def learn(docs: DataFrame) -> dict[str, list[bytes]]:
    """Raw dictionary contents per language from labelled rows that are not held out, in the order of a hash of the id.

    Rows count whatever their length: of a long text a piece is taken. Texts without a letter are passed over.
    """
    usable = docs.where("lang is not null and text is not null and doc_id is not null").where(~held_out()).where(F.col("text").rlike(_HAS_LETTER))
    # A share of each language's rows by the hash of their id leaves about twice as many as are wanted, whatever it has;
    # copies of one row are one.
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    share = counts.select("lang", F.least(F.lit(1.0), F.lit(2.0 * SAMPLE_ROWS + 100) / F.col("rows")).alias("share"))
    # As many rows as languages, whose dictionaries all go to every task later on. The lowest hashes are drawn.
    lowest = F.lit(-(2.0**63)) + F.col("share") * F.lit(2.0**64)
    drawn = usable.join(F.broadcast(share), "lang").where(F.xxhash64("doc_id").cast("double") <= lowest)
    pieces = drawn.select("lang", "doc_id", F.substring(F.regexp_replace("text", _BEFORE_LETTERS, ""), 1, SAMPLE_CHARS).alias("text")).distinct()
    by_hash = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    sample = pieces.withColumn("n", F.row_number().over(by_hash)).where(f"n <= {SAMPLE_ROWS}")
    texts: dict[str, list[str]] = {}
    for row in sample.select("lang", "n", "text").orderBy("lang", "n").collect():
        texts.setdefault(row["lang"], []).append(letters(row["text"]))
    dealt = {
        lang: [" ".join(parts[k::DICTIONARIES]).encode()[-DICTIONARY_BYTES:] for k in range(DICTIONARIES)] for lang, parts in texts.items()
    }
    return {lang: filled for lang, contents in dealt.items() if (filled := [c for c in contents if c.strip()])}


class Compressors:
    """One compressor per dictionary; sizes of a text under each language, a mean over its dictionaries."""

    def __init__(self, contents: dict[str, list[bytes]], level: int = LEVEL):
        self.langs = sorted(contents)
        self._by_lang = []
        for lang in self.langs:
            own = []
            for content in contents[lang]:
                data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                data.precompute_compress(level=level)
                own.append(
                    zstandard.ZstdCompressor(
                        level=level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
                    ).compress
                )
            self._by_lang.append(own)

    def sizes(self, text: str) -> list[float]:
        data = text.encode()
        blocks = [data[at : at + BLOCK] for at in range(0, len(data), BLOCK)]
        return [sum(len(compress(block)) for compress in own for block in blocks) / len(own) for own in self._by_lang]


def decide(langs: list[str], sizes: list[float], temper: float = 2.0) -> tuple[str, float, float]:
    """Language of the smallest size (ties: the first by name), a score of 0 to 1, and the margin to the next size in
    parts of it."""
    best = min(range(len(sizes)), key=lambda k: (sizes[k], langs[k]))
    others = [s for k, s in enumerate(sizes) if k != best]
    score = 1 / (1 + sum(math.exp(min(0.0, (sizes[best] - s) / temper)) for s in others))
    return langs[best], score, (min(others) - sizes[best]) / min(others) if others else 1.0


def is_settled(sizes: list[float], margin: float, narrow: float) -> bool:
    """Whether the first look is enough: a wide margin, or one that is not narrow and many bytes."""
    if margin >= SECOND_LOOK:
        return True
    best, following = sorted(sizes)[:2]
    return margin >= narrow and following - best >= CERTAIN_BYTES


def identify(docs: DataFrame, contents: dict[str, list[bytes]], narrow: float = 0.02) -> DataFrame:
    """doc_id, lang_pred, score, lang and margin of every whole text.

    ``lang_pred`` is always a learned language, ``und`` where the text is null or has no letter, or nothing was learned;
    the score is 0 then. ``lang`` is the same but ``und`` also where the margin is under ``narrow``. Rows repeat as
    often as in ``docs``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(contents)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = Compressors({lang: own[:1] for lang, own in shared.value.items()})
        second = Compressors(shared.value, SECOND_LEVEL)

        def look(words: str) -> tuple[str, float, float]:
            sizes = first.sizes(words)
            found = decide(first.langs, sizes)
            return found if is_settled(sizes, found[2], narrow) else decide(second.langs, second.sizes(words))

        for batch in batches:
            found = []
            for (text,) in rows_of(batch, "text"):
                words = letters(text or "")
                found.append(look(words) if words and first.langs else ("und", 0.0, 0.0))
            langs, scores, margins = zip(*found, strict=True) if found else ((), (), ())
            kept = [lang if margin >= narrow else "und" for lang, margin in zip(langs, margins, strict=True)]
            columns = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(kept, pa.string()), pa.array(margins, pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "lang_pred", "score", "lang", "margin"])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(compute, "doc_id long, lang_pred string, score double, lang string, margin double")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", doc_id="long", text="string", lang="string")
    found = identify(docs.drop("lang"), learn(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.col("lang").alias("lang_kept"), "margin")
