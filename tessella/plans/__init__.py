"""The registered queries: the operators over the given tables, each with the SQL that it is held against."""

from . import corpus, inference, publishing, terms
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "corpus", "inference", "publishing", "terms"]
