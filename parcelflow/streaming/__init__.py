"""Structured Streaming entry points: the incremental clean and the unloaded-not-scanned report."""

from .incremental import cleaned, fold, start_incremental_clean  # noqa: F401
from .unscan import start_unscanned, unscanned  # noqa: F401
