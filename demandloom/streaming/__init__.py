"""Record scoring as a stream of micro-batches."""

from .scoring import score_stream  # noqa: F401
