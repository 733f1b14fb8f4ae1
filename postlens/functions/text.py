"""Column functions for words and topics (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stop-word list of the batch word count, in its original
# order (144 entries).
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these",
    "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by",
    "for", "with", "about", "against", "between", "into", "through", "during", "before", "after", "above", "below",
    "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once", "here",
    "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such",
    "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "says", "new", "us", "say", "said", "one", "two", "—", "-", "+", "--", ".", ",", "=", "...", ":", "@",
)
# The streaming word count appends these two entries.
STREAM_STOP_WORDS = STOP_WORDS + ('"', ":")

# Characters deleted from a word before the stop-word test.
PUNCTUATION_DELETED = ".:()@"

# Topic patterns used by the marts (case-insensitive substring regexes).
TOPIC_A = "(?i)licen[cs]e?"
TOPIC_B = "(?i)the"


def split_words(text: Column | str) -> Column:
    """Split on single spaces (double spaces give empty words, newlines stay)."""
    return F.split(F.col(text) if isinstance(text, str) else text, " ")


def clean_word(word: Column | str) -> Column:
    """Delete ``.:()@`` and lower-case."""
    w = F.col(word) if isinstance(word, str) else word
    return F.lower(F.translate(w, PUNCTUATION_DELETED, ""))


def is_stop_word(word: Column | str, stop_words=STOP_WORDS) -> Column:
    """True for stop words (case-insensitive); null for a null word."""
    w = F.col(word) if isinstance(word, str) else word
    return F.lower(w).isin(list(stop_words))


def word_pattern(word: str) -> str:
    """Case-insensitive whole-word pattern with ASCII word boundaries.

    Written without ``\\b`` so that Java regex and RE2 agree on non-ASCII
    neighbours.
    """
    return f"(?i)(^|[^A-Za-z0-9_]){word}([^A-Za-z0-9_]|$)"


def mentions(text: Column | str, pattern: str) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return t.rlike(pattern)
