"""Spark operators for collecting, scoring and filtering model replies at scale."""

from replyforge.config import FieldNames, StatusSets, load_config

__all__ = ["FieldNames", "StatusSets", "load_config"]
