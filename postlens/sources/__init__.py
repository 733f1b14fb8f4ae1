from . import envelopes, streams, tables  # noqa: F401
from .envelopes import build_envelopes, read_envelopes, write_envelopes  # noqa: F401
from .streams import read_stream  # noqa: F401
from .tables import Tables  # noqa: F401
