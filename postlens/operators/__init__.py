from . import aggregates, flatten, joins, messages, windows, words  # noqa: F401
