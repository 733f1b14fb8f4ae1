"""Word pipelines over whole texts.

``clean_words`` = split on " ", explode, delete ``.:()@``, lower-case, drop
stop words (the batch word count).  ``raw_words`` = split, explode, drop
words whose lower case is a stop word, keep the original case (the
streaming word count).  Both stay inside whole-stage codegen: a Generate
followed by a filter on an ``INSET``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import STOP_WORDS, STREAM_STOP_WORDS, clean_word, is_stop_word, split_words


def clean_words(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = (),
                stop_words=STOP_WORDS) -> DataFrame:
    """Cleaned words of whole texts.

    Cleaning commutes with splitting on " ": the deleted characters are not
    spaces, and lower-casing maps nothing to or from a space and uses no
    context across one.  So each text is cleaned once and then split, which
    halves the per-word work; the words are already lower case for the
    stop-word test.
    """
    words = df.select(*keep, F.explode(split_words(clean_word(text_col))).alias("word"))
    return words.where(~F.col("word").isin(list(stop_words)))


def raw_words(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = (),
              stop_words=STREAM_STOP_WORDS) -> DataFrame:
    return (df.select(*keep, F.explode(split_words(text_col)).alias("word"))
            .where(~is_stop_word("word", stop_words)))


def word_frequency(words: DataFrame, word_col: str = "word") -> DataFrame:
    """``groupBy(word).count()``: partial counts per map task, one shuffle."""
    return words.groupBy(word_col).agg(F.count(F.lit(1)).alias("count"))


def top_words(words: DataFrame, k: int = 10, word_col: str = "word") -> DataFrame:
    """The k most frequent words, ties broken by the word.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top k, so no global sort of the vocabulary.
    """
    return (word_frequency(words, word_col)
            .orderBy(F.desc("count"), F.asc(word_col)).limit(k))


def tokens_per_post(df: DataFrame, clean: bool = True, id_col: str = "tweet_id",
                    text_col: str = "text") -> DataFrame:
    """Per post: number of words the pipeline keeps (whole text)."""
    fn = clean_words if clean else raw_words
    words = fn(df, text_col, keep=(id_col,))
    return words.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_words"))


def stop_word_split(df: DataFrame, id_col: str = "tweet_id", text_col: str = "text",
                    stop_words=STOP_WORDS) -> DataFrame:
    """Per post: all words, words kept and words removed by the stop list."""
    w = df.select(id_col, F.explode(split_words(text_col)).alias("word"))
    stop = is_stop_word("word", stop_words)
    return (w.groupBy(id_col)
            .agg(F.count(F.lit(1)).alias("n_words"),
                 F.count_if(~stop).alias("n_kept"),
                 F.count_if(stop).alias("n_stop")))
