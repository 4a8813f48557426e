"""The corpus pipeline: language, near-duplicates, benchmark leaks, mixture, shards."""

from __future__ import annotations

from pagecat.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
