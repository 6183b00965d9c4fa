"""Text column expressions: tokenizer, document-line and category-link parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the input formats (must equal the reference's for equal results):
#   document line  <doc id="ID" url="URL" ...>TEXT</doc>
#   id starts after the marker  id="   and ends before the marker  " url=
#   text starts after the first  ">   and loses its last 6 characters (</doc>)
#   category link  "ID","CATEGORY"  split on commas, double quotes removed
#   tokens are runs of ASCII letters, lower-cased
ID_MARKER = 'id="'
URL_MARKER = '" url='
BODY_MARKER = '">'
CLOSING_LENGTH = 6
NON_LETTERS = "[^a-zA-Z]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text: Column | str) -> Column:
    """Text → array of lower-case words (maximal runs of ASCII letters).

    Non-letters become spaces *before* lower-casing: lower-casing first would turn
    non-ASCII letters such as the Kelvin sign into ASCII ones.  After the replace
    only letters and single spaces remain, so trimming and splitting on one space
    leaves no empty token except for a text without letters, which
    ``array_remove`` clears.  All built-ins with code generation (no lambda).
    """
    spaced = F.trim(F.lower(F.regexp_replace(_col(text), NON_LETTERS, " ")))
    return F.array_remove(F.split(spaced, " "), "")


def _markers(line: Column) -> tuple[Column, Column, Column]:
    return (
        F.locate(ID_MARKER, line),
        F.locate(URL_MARKER, line),
        F.locate(BODY_MARKER, line),
    )


def is_doc_line(line: Column | str) -> Column:
    """A line holding all three markers (this implies it contains 'id' and 'url=')."""
    line = _col(line)
    id_at, url_at, body_at = _markers(line)
    return (id_at > 0) & (url_at > 0) & (body_at > 0)


def doc_line_id(line: Column | str) -> Column:
    line = _col(line)
    id_at, url_at, _ = _markers(line)
    start = id_at + F.lit(len(ID_MARKER))
    # A negative length (url marker before the id marker) gives the empty string.
    return F.substr(line, start, url_at - start)


def doc_line_text(line: Column | str) -> Column:
    line = _col(line)
    _, _, body_at = _markers(line)
    start = body_at + F.lit(len(BODY_MARKER))
    body_length = F.length(line) - start + F.lit(1)
    return F.substr(line, start, body_length - F.lit(CLOSING_LENGTH))


def _link_field(line: Column | str, index: int) -> Column:
    # try_element_at: a line without a comma yields null instead of an ANSI error.
    field = F.try_element_at(F.split(_col(line), ","), F.lit(index))
    return F.replace(field, F.lit('"'), F.lit(""))


def link_doc_id(line: Column | str) -> Column:
    return _link_field(line, 1)


def link_category(line: Column | str) -> Column:
    return _link_field(line, 2)
