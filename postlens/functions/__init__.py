from .text import (  # noqa: F401
    STOP_WORDS,
    STREAM_STOP_WORDS,
    clean_word,
    is_stop_word,
    mentions,
    split_words,
    word_pattern,
)
from .time import epoch_seconds, seconds  # noqa: F401
