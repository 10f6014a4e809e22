"""Boxes are structs (x, y, w, h) in page units 0 to 1, from the top left."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x, y, w, h) -> Column:
    return F.struct(*[(F.lit(v) if isinstance(v, float) else v).alias(n) for n, v in zip("xywh", (x, y, w, h))])


def centre_in(b: Column, r: Column, margin: float = 0.0) -> Column:
    """The centre of b lies in r, edges included."""
    cx, cy = b["x"] + b["w"] / 2, b["y"] + b["h"] / 2
    return cx.between(r["x"] - margin, r["x"] + r["w"] + margin) & cy.between(r["y"] - margin, r["y"] + r["h"] + margin)


def overlaps(a: Column, b: Column, margin: float = 0.0) -> Column:
    """The boxes, widened by the margin, share an area; touching is not enough."""
    return (a["x"] - margin < b["x"] + b["w"]) & (b["x"] - margin < a["x"] + a["w"]) & (a["y"] - margin < b["y"] + b["h"]) & (b["y"] - margin < a["y"] + a["h"])


def union(a: Column, b: Column) -> Column:
    x, y = F.least(a["x"], b["x"]), F.least(a["y"], b["y"])
    return box(x, y, F.greatest(a["x"] + a["w"], b["x"] + b["w"]) - x, F.greatest(a["y"] + a["h"], b["y"] + b["h"]) - y)


def padded(b: Column, pad: float, digits: int = 4, half_even: bool = False) -> Column:
    """Widened on all sides, cut to the page and rounded (half up, or half to even)."""
    r = F.bround if half_even else F.round
    x, y = F.greatest(F.lit(0.0), b["x"] - pad), F.greatest(F.lit(0.0), b["y"] - pad)
    right, low = F.least(F.lit(1.0), b["x"] + b["w"] + pad), F.least(F.lit(1.0), b["y"] + b["h"] + pad)
    return box(r(x, digits), r(y, digits), r(right - x, digits), r(low - y, digits))


def to_pixels(b: Column, width: Column, height: Column) -> Column:
    return F.struct(F.floor(b["x"] * width).alias("x0"), F.floor(b["y"] * height).alias("y0"), F.ceil((b["x"] + b["w"]) * width).alias("x1"), F.ceil((b["y"] + b["h"]) * height).alias("y1"))


def flipped(b: Column) -> Column:
    """From a bottom-left to a top-left origin, or back."""
    return box(b["x"], F.lit(1.0) - b["y"] - b["h"], b["w"], b["h"])


def remapped(b: Column, roi: Column) -> Column:
    """From coordinates inside a region to page coordinates."""
    return box(roi["x"] + b["x"] * roi["w"], roi["y"] + b["y"] * roi["h"], b["w"] * roi["w"], b["h"] * roi["h"])


def is_body_text(text: Column, b: Column, site: tuple[str, ...] = ()) -> Column:
    """A wide, long or marginal line, or one that holds a text of ``site`` in either case."""
    marked = F.exists(F.array(*[F.lit(s) for s in site]), lambda s: F.contains(F.lower(text), s)) if site else F.lit(False)
    return marked | (b["w"] > 0.28) | (F.char_length(text) >= 22) | (b["y"] < 0.07) | (b["y"] + b["h"] > 0.93)


def is_figure_size(b: Column) -> Column:
    return ~((b["y"] + b["h"] < 0.07) | (b["y"] > 0.93)) & (b["w"] * b["h"] >= 0.012) & (b["w"] >= 0.08) & (b["h"] >= 0.035)


def is_finding_size(b: Column, ink: Column) -> Column:
    return (b["w"] >= 0.012) & (b["h"] >= 0.007) & (ink >= 40)


def finding_kind(b: Column, fill: Column) -> Column:
    return F.when((fill > 0.55) & (b["w"] * b["h"] > 0.002), "dark").when(b["h"] <= 0.05, "text").otherwise("blob")


def row_kind(cells: Column, first_width: Column) -> Column:
    """Kind of a layout row from its cell texts: one wide line is text, short cells without '=' are a label, several cells or an operator before a digit are preformatted."""
    joined = F.array_join(cells, " ")
    short = F.forall(cells, lambda c: F.char_length(c) <= 4) & ~F.contains(joined, F.lit("="))
    return F.when((F.size(cells) == 1) & (first_width >= 0.45), "text").when(short, "label").when((F.size(cells) > 1) | joined.rlike(r"[=+×/]\s*\d"), "pre").otherwise("text")
