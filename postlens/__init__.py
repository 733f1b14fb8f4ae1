"""postlens: social-post analytics expressed as plain PySpark DataFrame and
Structured Streaming code.

Posts, users and media arrive either as nested API envelopes (batch) or as
JSON messages in Kafka-shaped records (streams).  Everything in this package
takes and returns DataFrames; Catalyst plans the work.
"""

__all__ = ["session", "schemas"]
