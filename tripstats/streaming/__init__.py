"""The streaming job that fills the store, and the fold of its partials into totals."""

from tripstats.streaming.folding import fold_all, recomputed
from tripstats.streaming.ingest import Job, start

__all__ = ["Job", "fold_all", "recomputed", "start"]
