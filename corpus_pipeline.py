"""The pipeline from raw documents to token files; its stages are those of ``sheetstar.llm.pipeline``."""

from sheetstar.llm.pipeline import ORACLE_SQL, STAGES, run  # noqa: F401
