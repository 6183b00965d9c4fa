"""Column expressions.  All are built-in Spark functions (JVM side, codegen), no Python UDF."""

from strata.functions.numeric import logistic, round_score, safe_double
from strata.functions.text import (
    doc_line_id,
    doc_line_text,
    is_doc_line,
    link_category,
    link_doc_id,
    tokenize,
)

__all__ = [
    "safe_double",
    "round_score",
    "logistic",
    "tokenize",
    "is_doc_line",
    "doc_line_id",
    "doc_line_text",
    "link_doc_id",
    "link_category",
]
