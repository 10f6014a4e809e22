"""Figure regions from ink cells: grid counts, dilation, components, absorbed labels and merged boxes.

Pages are independent and bounded (a raster), so the iterative steps run as one grouped map by page.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.boxes import box, finding_kind, is_body_text, is_finding_size
from ..functions.text import chapter_name, figure_file
from .joins import to_section, upserted

BOX = "x double, y double, w double, h double"


def grid(pixels: DataFrame, cell: int, least: int) -> DataFrame:
    """(page, cx, cy, ink) of grid cells that hold at least ``least`` ink pixels (page, x, y)."""
    return pixels.groupBy("page", F.floor(F.col("x") / cell).cast("int").alias("cx"), F.floor(F.col("y") / cell).cast("int").alias("cy")).agg(F.count("*").cast("int").alias("ink")).filter(F.col("ink") >= least)


def dilated(cells: DataFrame, rx: int, ry: int) -> DataFrame:
    """Distinct cells within rx, ry of an ink cell, not below 0."""
    offsets = F.flatten(F.transform(F.sequence(F.lit(-rx), F.lit(rx)), lambda dx: F.transform(F.sequence(F.lit(-ry), F.lit(ry)), lambda dy: F.struct(dx.alias("dx"), dy.alias("dy")))))
    return cells.withColumn("o", F.explode(offsets)).select("page", (F.col("cx") + F.col("o.dx")).alias("cx"), (F.col("cy") + F.col("o.dy")).alias("cy")).filter("cx >= 0 AND cy >= 0").distinct()


def flood(cells: set[tuple[int, int]]) -> dict[tuple[int, int], int]:
    """4-neighbour components, numbered in row-major order of their first cell."""
    label: dict[tuple[int, int], int] = {}
    for start in sorted(cells, key=lambda c: (c[1], c[0])):
        if start in label:
            continue
        own = len(set(label.values())) if not label else max(label.values()) + 1
        todo = [start]
        label[start] = own
        while todo:
            x, y = todo.pop()
            for n in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if n in cells and n not in label:
                    label[n] = own
                    todo.append(n)
    return label


def components(cells: DataFrame, grown: DataFrame | None = None) -> DataFrame:
    """(page, cx, cy, ink, comp): components of the grown cells, told for the ink cells."""
    g = cells.select("page", "cx", "cy", F.col("ink").cast("int").alias("ink"))
    if grown is not None:
        g = g.unionByName(grown.join(cells, ["page", "cx", "cy"], "left_anti").select("page", "cx", "cy", F.lit(0).alias("ink")))

    def run(p: pd.DataFrame) -> pd.DataFrame:
        label = flood(set(zip(p["cx"], p["cy"])))
        p = p.assign(comp=[label[c] for c in zip(p["cx"], p["cy"])])
        return p[p["ink"] > 0][["page", "cx", "cy", "ink", "comp"]]

    return g.groupBy("page").applyInPandas(run, "page int, cx int, cy int, ink int, comp int")


def bounds(comps: DataFrame) -> DataFrame:
    """Cell bounds, ink and fill ratio of each component."""
    got = comps.groupBy("page", "comp").agg(F.min("cx").alias("x0"), F.min("cy").alias("y0"), F.max("cx").alias("x1"), F.max("cy").alias("y1"), F.sum("ink").cast("long").alias("ink"), F.count("*").alias("cells"))
    return got.withColumn("fill", F.col("cells") / ((F.col("x1") - F.col("x0") + 1) * (F.col("y1") - F.col("y0") + 1)))


def tallest(comps: DataFrame) -> DataFrame:
    """The tallest component of each page; of equals the first in row-major order."""
    b = bounds(comps)
    return b.groupBy("page").agg(F.max_by("comp", F.struct((F.col("y1") - F.col("y0")).alias("h"), (-F.col("comp")).alias("first"))).alias("comp"))


def _meet(a, b, m):
    return a[0] - m < b[0] + b[2] and b[0] - m < a[0] + a[2] and a[1] - m < b[1] + b[3] and b[1] - m < a[1] + a[3]


def _join(a, b):
    x, y = min(a[0], b[0]), min(a[1], b[1])
    return [x, y, max(a[0] + a[2], b[0] + b[2]) - x, max(a[1] + a[3], b[1] + b[3]) - y]


def merge_boxes(boxes: list, margin: float) -> list:
    """Joins overlapping boxes until none overlap; a join may reach boxes that neither part touched."""
    done: list = []
    todo = [list(b) for b in boxes]
    while todo:
        b = todo.pop(0)
        hit = next((i for i, d in enumerate(done) if _meet(d, b, margin)), None)
        if hit is None:
            done.append(b)
        else:
            todo.insert(0, _join(done.pop(hit), b))
    return sorted(done, key=lambda b: (b[1], b[0]))


def absorb(box: list, labels: list, reach: float) -> list:
    """Labels, in order, whose centre lies within ``reach`` of the box as it has grown so far."""
    for lab in labels:
        cx, cy = lab[0] + lab[2] / 2, lab[1] + lab[3] / 2
        if box[0] - reach <= cx <= box[0] + box[2] + reach and box[1] - reach <= cy <= box[1] + box[3] + reach:
            box = _join(box, lab)
    return box


def merged(boxes: DataFrame, margin: float = 0.012) -> DataFrame:
    """(page, k, x, y, w, h): merged boxes of each page in reading order."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        out = merge_boxes(p.sort_values(["y", "x", "w", "h"])[["x", "y", "w", "h"]].values.tolist(), margin)
        return pd.DataFrame([(p["page"].iloc[0], i + 1, *b) for i, b in enumerate(out)], columns=["page", "k", "x", "y", "w", "h"])

    return boxes.select("page", "x", "y", "w", "h").groupBy("page").applyInPandas(run, f"page int, k int, {BOX}")


def with_labels(boxes: DataFrame, labels: DataFrame, reach: float = 0.025) -> DataFrame:
    """Boxes grown by the labels they absorb, in label order."""

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        labs = b.sort_values("line_no")[["x", "y", "w", "h"]].values.tolist()
        out = a.copy()
        if len(a):
            out[["x", "y", "w", "h"]] = [absorb(list(x), labs, reach) for x in a[["x", "y", "w", "h"]].values.tolist()]
        return out

    return boxes.select("page", "k", "x", "y", "w", "h").groupBy("page").cogroup(labels.select("page", "line_no", "x", "y", "w", "h").groupBy("page")).applyInPandas(run, f"page int, k int, {BOX}")


def _cells_of(ink: np.ndarray, c: int, least: int) -> np.ndarray:
    h, w = -(-ink.shape[0] // c) * c, -(-ink.shape[1] // c) * c
    full = np.zeros((h, w), np.int32)
    full[: ink.shape[0], : ink.shape[1]] = ink
    return full.reshape(h // c, c, w // c, c).sum(axis=(1, 3)) * (full.reshape(h // c, c, w // c, c).sum(axis=(1, 3)) >= least)


def page_components(gray: np.ndarray, erase: list, cell: int, least: int, rx: int, ry: int, dark: int = 128, invert_below: float | None = None) -> list:
    """Lists of the ink cells (cx, cy, ink) of the components of a gray page after erasing boxes: grid, dilation and flood in one pass."""
    if invert_below is not None and gray.mean() < invert_below:
        gray = 255 - gray
    ink = gray < dark
    h, w = ink.shape
    for x0, y0, x1, y1 in erase:
        ink[max(0, int(y0 * h)) : max(0, int(y1 * h)), max(0, int(x0 * w)) : max(0, int(x1 * w))] = False
    n = _cells_of(ink, cell, least)
    on = n > 0
    grown = np.zeros_like(on)
    for dy in range(-ry, ry + 1):
        for dx in range(-rx, rx + 1):
            src = on[max(0, -dy) : on.shape[0] - max(0, dy), max(0, -dx) : on.shape[1] - max(0, dx)]
            grown[max(0, dy) : max(0, dy) + src.shape[0], max(0, dx) : max(0, dx) + src.shape[1]] |= src
    label = flood({(int(x), int(y)) for y, x in zip(*np.nonzero(grown))})
    own: dict[int, list] = {}
    for y, x in zip(*np.nonzero(on)):
        own.setdefault(label[int(x), int(y)], []).append((int(x), int(y), int(n[y, x])))
    return list(own.values())


def page_regions(gray: np.ndarray, erase: list, cell: int, least: int, rx: int, ry: int, dark: int = 128, invert_below: float | None = None) -> list:
    """(x, y, w, h, ink, fill) of the components of a gray page, in page units; fill is the share of ink in the box's pixels."""
    (h, w), out = gray.shape, []
    for cells in page_components(gray, erase, cell, least, rx, ry, dark, invert_below):
        x0, y0, x1, y1 = min(c[0] for c in cells), min(c[1] for c in cells), max(c[0] for c in cells) + 1, max(c[1] for c in cells) + 1
        out.append((x0 * cell / w, y0 * cell / h, (x1 - x0) * cell / w, (y1 - y0) * cell / h, (n := sum(c[2] for c in cells)), n / ((x1 - x0) * (y1 - y0) * cell * cell)))
    return out


def in_labels(cells: list, labels: list, cell: int, width: int, height: int, margin: float = 0.004) -> float:
    """The share of a region's ink cells whose centre lies in a label box."""
    at = [((cx + 0.5) * cell / width, (cy + 0.5) * cell / height) for cx, cy, _ in cells]
    held = lambda x, y: any(a - margin <= x <= a + w + margin and b - margin <= y <= b + h + margin for a, b, w, h in labels)
    return sum(held(x, y) for x, y in at) / len(at)


def page_figures(gray: np.ndarray, erase: list, labels: list, cell: int = 6, pad: float = 0.012, reach: float = 0.025, text_only: float = 0.85) -> list:
    """Figure boxes of a gray page in reading order: regions off the page's edge bands, grown by their labels, of a figure's size, not made of label text, joined, padded and rounded."""
    height, width = gray.shape
    boxes = []
    for cells in page_components(gray, erase, cell, 4, 3, 3, dark=170):
        xs, ys = [c[0] for c in cells], [c[1] for c in cells]
        b = [min(xs) * cell / width, min(ys) * cell / height, (max(xs) - min(xs) + 1) * cell / width, (max(ys) - min(ys) + 1) * cell / height]
        if b[1] + b[3] < 0.07 or b[1] > 0.93:
            continue
        b = absorb(b, labels, reach)
        if b[2] * b[3] >= 0.012 and b[2] >= 0.08 and b[3] >= 0.035 and in_labels(cells, labels, cell, width, height) <= text_only:
            boxes.append(b)
    made = []
    for x, y, w, h in merge_boxes(boxes, pad):
        x0, y0 = max(0.0, x - pad), max(0.0, y - pad)
        made.append([float(np.floor(v * 10_000 + 0.5) / 10_000) for v in (x0, y0, min(1.0, x + w + pad) - x0, min(1.0, y + h + pad) - y0)])
    return made


def detected(images: DataFrame, lines: DataFrame, site: tuple[str, ...] = ()) -> DataFrame:
    """(page, boxes) of the pages with figures, from (page, width, height, data: 8-bit gray) and OCR lines (page, line_no, text, x, y, w, h).

    Body text and lines that hold a text of ``site`` are erased with room for accents, the others are labels. A page
    without lines is searched as it is.
    """
    x, y, w, h = (F.col(c) for c in "xywh")
    body = is_body_text(F.col("text"), F.struct("x", "y", "w", "h"), site)
    erase = F.collect_list(F.when(body, F.array(x - 0.005, y - 0.35 * h, x + w + 0.005, y + 1.2 * h)))
    labels = F.transform(F.array_sort(F.collect_list(F.when(~body, F.struct("line_no", "x", "y", "w", "h")))), lambda b: F.array(b["x"], b["y"], b["w"], b["h"]))
    per = lines.groupBy("page").agg(erase.alias("erase"), labels.alias("labels"))

    def run(batches):
        for p in batches:
            found = []
            for r in p.itertuples(index=False):
                gray = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width)
                lists = [[] if v is None else [list(b) for b in v] for v in (r.erase, r.labels)]
                found.append((r.page, page_figures(gray, *lists)))
            yield pd.DataFrame([f for f in found if f[1]], columns=["page", "boxes"])

    return images.join(per, "page", "left").select("page", "width", "height", "data", "erase", "labels").mapInPandas(run, "page int, boxes array<array<double>>")


def figure_table(auto: DataFrame, exclude: DataFrame, override: DataFrame, chapters: DataFrame) -> DataFrame:
    """(page, k, box, no, chapter, section, file) of the detected figures (page, boxes) after exclusions (page) and overrides (page, boxes)."""
    each = upserted(auto, exclude, override, "page", "boxes").select("page", F.posexplode("boxes").alias("k", "box")).withColumn("k", F.col("k") + 1)
    named = to_section(each, chapters)
    no, label = F.col("chapter.no"), F.col("chapter.label") if "label" in chapters.columns else F.lit(None).cast("string")
    return named.select("page", "k", "box", no.alias("no"), chapter_name(label, F.col("chapter.title")).alias("chapter"), "section", figure_file(no, F.col("page"), F.col("k")).alias("file"))


def unexplained(images: DataFrame, lines: DataFrame, figures: DataFrame) -> DataFrame:
    """(page, box, kind, ink): regions of ink outside OCR lines, figures (page, x, y, w, h) and the bands at the top and the foot of a page."""
    x, y, w, h = (F.col(c) for c in "xywh")
    text = lines.select("page", (x - 0.006).alias("x"), (y - 0.4 * h).alias("y"), (w + 0.012).alias("w"), (1.65 * h).alias("h"))
    edges = F.array(box(0.0, 0.0, 1.0, 0.065), box(0.0, 0.935, 1.0, 0.065))
    bands = images.select("page", F.explode(edges).alias("b")).select("page", "b.*")
    found = scanned(images, text.unionByName(figures.select("page", "x", "y", "w", "h")).unionByName(bands), dark=150)
    b = F.struct("x", "y", "w", "h")
    sized = found.filter(is_finding_size(b, F.col("ink")))
    rounded = F.struct(*[F.round(c, 4).alias(c) for c in "xywh"])
    return sized.select("page", rounded.alias("box"), finding_kind(b, F.col("fill")).alias("kind"), F.round("fill", 2).alias("ink"))


def planned(specs: DataFrame, results: DataFrame) -> DataFrame:
    """(page, fix_no, kind, cap, replace, lines): region fixes from specs (page, fix_no, kind, box) and the readings of their regions (page, fix_no, cap, lines).

    A drop cap has two lines beside it, which share the second's x and the larger right end, and replaces from the cap
    to the page's text edge; another number of lines is an error. A block replaces its box with its lines by y. Boxes
    are arrays x, y, w, h; a spec without reading has no fix.
    """
    t = specs.join(results, ["page", "fix_no"])
    r4 = lambda c: F.bround(c, 4)
    line = lambda s, x, w: F.struct(s["text"].alias("text"), F.bround(s["conf"], 3).alias("conf"), r4(x).alias("x"), r4(s["y"]).alias("y"), r4(w).alias("w"), r4(s["h"]).alias("h"))
    two = F.when(F.size("lines") == 2, F.col("lines")).otherwise(F.raise_error(F.format_string("page %s: a drop cap needs 2 lines, not %s", "page", F.size("lines"))))
    x, right = two[1]["x"], F.array_max(F.transform(two, lambda s: s["x"] + s["w"]))
    left, top = F.col("cap")[0] - 0.01, F.col("cap")[1] - 0.008
    low = F.array_max(F.transform(two, lambda s: s["y"] + s["h"])) + 0.006
    by_y = F.transform(F.array_sort(F.transform("lines", lambda s: F.struct(s["y"].alias("at"), s.alias("s")))), lambda e: line(e["s"], e["s"]["x"], e["s"]["w"]))
    cap = F.col("kind") == "dropcap"
    return t.select(
        "page", "fix_no", "kind", F.when(cap, F.transform("cap", r4)).alias("cap"),
        F.when(cap, F.array(r4(left), r4(top), r4(0.97 - left), r4(low - top))).otherwise(F.col("box")).alias("replace"),
        F.when(cap, F.transform(two, lambda s: line(s, x, right - x))).otherwise(by_y).alias("lines"),
    )


def scanned(images: DataFrame, erase: DataFrame, cell: int = 4, least: int = 3, rx: int = 4, ry: int = 1, invert_below: float | None = 110, dark: int = 150) -> DataFrame:
    """(page, x, y, w, h, ink, fill) from (page, width, height, data: 8-bit gray) and boxes to erase (page, x, y, w, h)."""
    boxes = erase.groupBy("page").agg(F.collect_list(F.array(F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h"))).alias("erase"))

    def run(batches):
        for p in batches:
            rows = []
            for r in p.itertuples(index=False):
                gray = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width)
                e = [] if r.erase is None else [list(b) for b in r.erase]
                rows += [(r.page, *b) for b in page_regions(gray, e, cell, least, rx, ry, dark, invert_below)]
            yield pd.DataFrame(rows, columns=["page", "x", "y", "w", "h", "ink", "fill"])

    return images.join(boxes, "page", "left").select("page", "width", "height", "data", "erase").mapInPandas(run, f"page int, {BOX}, ink long, fill double")
