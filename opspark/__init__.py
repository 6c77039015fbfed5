"""opspark: operational analytics for demand series and question-answering logs on PySpark."""

from .session import cut_lineage, get_session

__all__ = ["cut_lineage", "get_session"]
