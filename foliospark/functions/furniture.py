"""Page furniture of OCR lines: site marks, running heads and page numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .similarity import similar
from .text import norm, printed_number


def is_site_mark(c: Column, mark: str, parts: tuple[str, ...] = (), least: float = 0.7) -> Column:
    """The normal form holds one of ``parts`` or is more than ``least`` similar to the mark."""
    held = [F.contains(norm(c), F.lit(p)) for p in parts]
    return F.coalesce(reduce(lambda a, b: a | b, held, similar(c, F.lit(mark)) > least), F.lit(False))


def is_running_head(c: Column, y: Column, heads: tuple[str, ...], top: float = 0.07, least: float = 0.75) -> Column:
    """A line at the top that is more than ``least`` similar to one of the heads."""
    return F.coalesce((y < top) & reduce(lambda a, b: a | b, [similar(c, F.lit(h)) > least for h in heads], F.lit(False)), F.lit(False))


def page_number(c: Column, y: Column, bottom: float = 0.92) -> Column:
    """The printed number of a line at the foot, else null."""
    return F.when(y > bottom, printed_number(c))


def is_furniture(c: Column, y: Column, mark: str, parts: tuple[str, ...], heads: tuple[str, ...]) -> Column:
    """Site mark, running head or page number: never false for one of them, never null."""
    return is_site_mark(c, mark, parts) | is_running_head(c, y, heads) | page_number(c, y).isNotNull()
