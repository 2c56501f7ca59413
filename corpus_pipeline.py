"""A training corpus from ``documents``; the stages are in ``daymosaic.llm.pipeline``."""

from daymosaic.llm.pipeline import ORACLE_SQL, STAGES, run  # noqa: F401
