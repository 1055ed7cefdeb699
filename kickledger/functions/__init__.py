"""Column expressions: tolerant typing, month keys, report text."""

from kickledger.functions import coerce, months, text

__all__ = ["coerce", "months", "text"]
