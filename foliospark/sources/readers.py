"""Sources with explicit schemas; a malformed control file fails."""

from __future__ import annotations

import subprocess

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.joins import with_fixes
from ..operators.order import carried

LINE = "struct<text:string,conf:double,x:double,y:double,w:double,h:double>"
OCR_PAGE = f"page int, width int, height int, lines array<{LINE}>"
REGION_FIX = f"page int, source string, fixes array<struct<kind:string,cap:array<double>,replace:array<double>,lines:array<{LINE}>>>"
CHAPTERS = "no string, slug string, label string, title string, first int, last int, sections array<array<string>>"


def json_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def ocr_lines(spark: SparkSession, path: str) -> DataFrame:
    """(page, line_no, text, conf, x, y, w, h): stripped lines with text. A missing page has no rows."""
    pages = json_file(spark, path, OCR_PAGE)
    lines = pages.select("page", F.posexplode("lines").alias("line_no", "l")).select("page", "line_no", "l.*")
    return lines.withColumn("text", strip(F.col("text"))).filter("text <> ''")


def pass_lines(spark: SparkSession, path: str, fixes: DataFrame | None = None) -> DataFrame:
    """``ocr_lines`` of a pass with its region fixes; footer passes and raw reads have no ``fixes``."""
    lines = ocr_lines(spark, path)
    if fixes is None:
        return lines
    return with_fixes(lines, fixes).withColumn("text", strip(F.col("text"))).filter("text <> ''")


def only(df: DataFrame, key: str, wanted: list) -> DataFrame:
    """Rows of the wanted keys; an empty list means all."""
    return df.filter(F.col(key).isin(wanted)) if wanted else df


def page_files(spark: SparkSession, folder: str, glob: str = "*.jpg") -> DataFrame:
    """(page, file) of files named by a page, as in ``p012-1.jpg`` or ``p012.png``; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder).select("path")
    named = found.select(F.regexp_extract("path", r"p(\d+)(?:-\d+)?\.[^./]*$", 1).alias("p"), F.element_at(F.split("path", "/"), -1).alias("file"))
    return named.filter("p <> ''").select(F.col("p").cast("int").alias("page"), "file")


def region_fixes(spark: SparkSession, path: str) -> DataFrame:
    """(page, fix_no, kind, cap, replace struct<x,y,w,h>, lines)."""
    f = json_file(spark, path, REGION_FIX).select("page", F.posexplode("fixes").alias("fix_no", "f")).select("page", "fix_no", "f.*")
    r = F.col("replace")
    return f.withColumn("replace", F.struct(*[r[i].alias(n) for i, n in enumerate("xywh")]))


def chapters(spark: SparkSession, path: str) -> DataFrame:
    c = json_file(spark, path, CHAPTERS)
    return c.withColumn("sections", F.transform("sections", lambda s: F.struct(s[0].alias("title"), s[1].cast("int").alias("page"))))


def json_map(spark: SparkSession, path: str, value: str, out: str) -> DataFrame:
    """(page, out) of a JSON object with page numbers as keys."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"map<string,{value}>", {"mode": "FAILFAST"})).alias("page", out)).withColumn("page", F.col("page").cast("int"))


def tsv(spark: SparkSession, path: str) -> DataFrame:
    """(row, cells): data lines in file order, from 1; blank lines and # comments are skipped but counted."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("row", "line"))
    return lines.filter("trim(line) <> '' AND NOT startswith(line, '#')").select((F.col("row") + 1).alias("row"), F.split("line", "\t").alias("cells"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, text), numbered from 1 in each file."""
    files = spark.read.text(path, wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("path"), "value")
    return files.select("path", F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("line_no", "text")).withColumn("line_no", F.col("line_no") + 1)


#: The page marker of a corpus line (page, printed number) and the beginnings of names that hold no pages.
MARKER = r"<!-- pdf:(\d+) \| sach:(\S+) -->"
NO_PAGES = ("_", "00-muc-luc")


def corpus_lines(spark: SparkSession, path: str, marker: str = MARKER, seed: bool = False, skip: tuple[str, ...] = NO_PAGES, numbered: bool = False) -> DataFrame:
    """(path, line_no, text, page, is_marker) of the files whose names don't begin with one of ``skip`` (``numbered``: that begin with two digits and a hyphen); each line has the page of the last marker."""
    lines = text_lines(spark, path)
    if numbered:
        lines = lines.filter(F.rlike("path", F.lit("^[0-9][0-9]-")))
    for start in skip:
        lines = lines.filter(~F.startswith("path", F.lit(start)))
    number = F.regexp_extract("text", marker, 1)
    lines = lines.withColumn("marker", F.when(number != "", number.cast("int")))
    return carried(lines, "marker", ["path"], ["line_no"], "page", seed).withColumn("is_marker", F.col("marker").isNotNull()).drop("marker")


def gray_images(spark: SparkSession, path: str) -> DataFrame:
    """(path, width, height, data) of 8-bit images as gray, row 0 on top."""
    import numpy as np
    import pandas as pd

    @F.pandas_udf("binary")
    def gray(data: pd.Series, n: pd.Series) -> pd.Series:
        weigh = np.array([0.114, 0.587, 0.299])  # blue, green, red
        return pd.Series([d if k == 1 else np.rint(np.frombuffer(d, np.uint8).reshape(-1, k)[:, :3] @ weigh).astype(np.uint8).tobytes() for d, k in zip(data, n)])

    i = spark.read.format("image").load(path).select("image.*")
    return i.select(F.element_at(F.split("origin", "/"), -1).alias("path"), "width", "height", gray("data", "nChannels").alias("data"))


def missing_files(wanted: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """Keys that have no file yet."""
    return wanted.join(listing, key, "left_anti")


def sha256_ok(content: Column, expected: Column) -> Column:
    return F.sha2(content, 256) == F.lower(expected)


def missing_pages(spark: SparkSession, first: int, last: int, folder: str, glob: str = "*.json") -> DataFrame:
    """(page): pages first to last without a file in the folder that is named by its number; contents are not read."""
    have = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select(F.regexp_extract("path", r"(\d+)\.[^./]*$", 1).cast("int").alias("page"))
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("page")).join(have, "page", "left_anti")


def command_rows(calls: DataFrame, args: str, command: list[str], schema: str) -> DataFrame:
    """The columns of ``calls`` and those of ``schema``: a child process for each row, called with the strings in the
    column ``args``, prints a JSON array of rows. A failing process fails the task, which Spark runs again."""

    @F.pandas_udf("string")
    def output(given: pd.Series) -> pd.Series:
        return given.map(lambda a: subprocess.run([*command, *(a if a is not None else [])], check=True, capture_output=True, text=True).stdout)

    rows = F.from_json(output(args), f"array<struct<{schema}>>", {"mode": "FAILFAST"})
    return calls.withColumn("_rows", rows).select(*calls.columns, F.inline("_rows"))
