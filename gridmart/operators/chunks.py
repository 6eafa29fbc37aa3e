"""Document chunking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words per chunk and words shared with the chunk before.
CHUNK_WORDS, OVERLAP_WORDS = 512, 50


def chunk_documents(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = CHUNK_WORDS,
    overlap: int = OVERLAP_WORDS,
) -> DataFrame:
    """Whole texts in chunks of ``size`` words that overlap by ``overlap`` words.

    Words are separated by white space. Chunks start every ``size - overlap`` words; a
    tail that lies wholly inside the chunk before is not a chunk of its own. Narrow: no
    shuffle, one row in, its chunks out.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    words = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    count = F.size("_words")
    starts = F.sequence(
        F.lit(0), F.greatest(count - F.lit(overlap) - 1, F.lit(0)), F.lit(size - overlap)
    )
    return (
        df.select(key, words.alias("_words"))
        .filter(count > 0)
        .select(key, "_words", F.posexplode(starts).alias("chunk_index", "_start"))
        .select(
            key,
            "chunk_index",
            F.least(count - F.col("_start"), F.lit(size)).alias("word_count"),
            F.array_join(F.slice("_words", F.col("_start") + 1, F.lit(size)), " ").alias("chunk_text"),
        )
    )


# A token with the white space before it: a word, a digit, or any other sign. Joined they are the text.
_GAP = r"[\x09-\x0D\x20]*"
TOKEN = rf"{_GAP}(?:[\p{{L}}\p{{M}}]+|\p{{N}}|[^\x09-\x0D\x20\p{{L}}\p{{M}}\p{{N}}])"


def chunk_tokens(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = CHUNK_WORDS,
    overlap: int = OVERLAP_WORDS,
) -> DataFrame:
    """As `chunk_documents`, but in tokens, which keep a chunk's length in bounds also where a text has
    few spaces: words, digits and other signs count one each. Chunks are cuts of the text as it stands,
    without the white space around them.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    count = F.size("_tokens")
    starts = F.sequence(
        F.lit(0), F.greatest(count - F.lit(overlap) - 1, F.lit(0)), F.lit(size - overlap)
    )
    joined = F.array_join(F.slice("_tokens", F.col("_start") + 1, F.lit(size)), "")
    return (
        df.select(key, F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0)).alias("_tokens"))
        .filter(count > 0)
        .select(key, "_tokens", F.posexplode(starts).alias("chunk_index", "_start"))
        .select(
            key,
            "chunk_index",
            F.least(count - F.col("_start"), F.lit(size)).alias("token_count"),
            F.regexp_replace(joined, rf"^{_GAP}", "").alias("chunk_text"),
        )
    )
