"""Secret scans with multipart credential linking (DataFrame functions only).

Patterns that are secrets on their own are always reported. Weak candidates (a random-looking token, an account
name, an endpoint) are reported only where complementary parts stand within ``SCOPE`` code points of them in the
same document: an interval join of the parts, done as two ordered sweeps, so no pairs are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, stored

SCOPE = 200
KINDS = ("assign", "access", "hex", "weak", "ident", "endpoint")
# The base patterns, then the parts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
WEAK = r"[A-Za-z0-9+/_-]{20,}={0,2}"
IDENT = r"""(?i)(user(?:_?name)?|login|client_?id|account(?:_?id)?|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})"""
ENDPOINT = r"""(?:https?|ftp|postgres(?:ql)?|mysql|redis|mongodb|amqp|s3)://[^\x00-\x20"'<>]+"""
SPAN = "array<struct<start:int,end:int>>"


def spans_of(text: str, pattern: str, keep=None, needle: str | None = None) -> Column:
    """Spans (code points, end exclusive) of the leftmost non-overlapping matches that ``keep`` accepts.

    Matches come from one scan and the pieces between them from another by the same pattern; running lengths
    give the places.
    """
    col, p = F.col(text), F.lit(pattern)
    found = F.regexp_extract_all(col, p, F.lit(0))
    gaps = F.split(col, pattern, -1)
    rows = F.transform(F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("g")), lambda x: F.struct(x["m"].alias("m"), F.char_length(x["g"]).alias("g"), F.char_length(x["m"]).alias("l")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,m:string>>").alias("s"))
    step = lambda a, x: F.struct((a["at"] + x["g"] + x["l"]).alias("at"), F.concat(a["s"], F.array(F.struct((a["at"] + x["g"]).alias("start"), (a["at"] + x["g"] + x["l"]).alias("end"), x["m"].alias("m")))).alias("s"))
    all_ = F.aggregate(rows, start, step, lambda a: a["s"])
    if keep:
        all_ = F.filter(all_, lambda x: keep(x["m"]))
    slim = F.transform(all_, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    there = col.rlike(pattern) if needle is None else col.contains(needle) & col.rlike(pattern)
    return F.when(there, slim).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, scope: int = SCOPE, carry: bool = False) -> DataFrame:
    """doc_id (with ``carry`` also ``row``, a struct of all input columns), base and spans: arrays of struct<start, k, kind, end> by start, then kind.

    Null and empty text: no spans; a null doc_id is an id like any other; repeated rows get the same spans; an
    empty table gives no rows. ``base`` holds the kinds assign, access and hex; ``spans`` adds linked parts.
    """
    long_enough = lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= 8
    mixed = lambda m: m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]")
    row = [F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row")] if carry else []
    held = ["row"] if carry else []
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *row).withColumn("th", F.xxhash64("text"))
    found = stored(d.select(
        "doc_id", "th", *held, spans_of("text", ASSIGN, long_enough).alias("assign"), spans_of("text", ACCESS, needle="AKIA").alias("access"), spans_of("text", HEX).alias("hex"),
        spans_of("text", WEAK, mixed).alias("weak"), spans_of("text", IDENT).alias("ident"), spans_of("text", ENDPOINT, needle="://").alias("endpoint"),
    ))
    tagged = lambda kinds: F.array_sort(F.flatten(F.array(*[of_kind(k) for k in kinds])))
    base = found.select("doc_id", "th", *held, tagged(KINDS[:3]).alias("base"))
    ids, secrets, weak = F.size("access") + F.size("ident"), F.size("assign") + F.size("hex") + F.size("weak"), F.size("weak") + F.size("ident") + F.size("endpoint")
    parts = found.filter((ids > 0) & (secrets > 0) & (weak > 0)).select("doc_id", "th", tagged(KINDS).alias("p")).dropDuplicates(["doc_id", "th"])
    linked = link(parts.select("doc_id", "th", F.explode("p").alias("p")).select("doc_id", "th", "p.*"), scope)
    # Written, so that Spark knows its size and leaves the documents where they are while linked parts are few.
    linked = stored(linked.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "k", "kind", "end")).alias("more")))
    on = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.th") == F.col("b.th"))
    empty = F.array().cast("array<struct<start:int,k:int,kind:string,end:int>>")
    return base.alias("a").join(linked.alias("b"), on, "left").select("a.doc_id", *[f"a.{c}" for c in held], "base", F.array_sort(F.concat("base", F.coalesce("more", empty))).alias("spans"))


def of_kind(kind: str) -> Column:
    return F.transform(F.col(kind), lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("k"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def link(parts: DataFrame, scope: int) -> DataFrame:
    """Weak parts with complementary parts in scope: a token or a name needs the other one (an access key serves as a name, a base secret as a token), an endpoint needs both. A part overlapped by a base secret is none."""
    role = F.when(F.col("kind").isin("access", "ident"), "id").when(F.col("kind") == "endpoint", "endpoint").otherwise("secret")
    strong = F.col("k") < 3
    p = parts.withColumn("role", role)
    up = Window.partitionBy("doc_id", "th").orderBy("start", "k", "end").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("doc_id", "th").orderBy(F.desc("start"), F.desc("k"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    for r in ("id", "secret"):
        mine = F.col("role") == r
        p = p.withColumn(f"{r}_before", F.max(F.when(mine, F.col("end"))).over(up)).withColumn(f"{r}_after", F.min(F.when(mine, F.col("start"))).over(down))
    p = p.withColumn("over", F.max(F.when(strong, F.col("end"))).over(up)).withColumn("under", F.min(F.when(strong, F.col("start"))).over(down))
    near = lambda r: F.coalesce(F.col(f"{r}_before") >= F.col("start") - scope, F.lit(False)) | F.coalesce(F.col(f"{r}_after") <= F.col("end") + scope, F.lit(False))
    free = F.coalesce(F.col("over") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("under") >= F.col("end"), F.lit(True))
    ok = F.when(F.col("kind") == "weak", near("id")).when(F.col("kind") == "ident", near("secret")).when(F.col("kind") == "endpoint", near("id") & near("secret"))
    return p.filter(~strong & free & ok)


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: str, spans: str, mark: str = "[SECRET]") -> Column:
    """Text with every reported span replaced; overlapping spans share one mark."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    t = F.col(text)
    step = lambda a, s: F.when(s["start"] >= a["at"], F.struct(s["end"].alias("at"), F.concat(a["out"], F.array(F.substring(t, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).alias("out"))).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out")))
    whole = F.aggregate(F.col(spans), start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(t, a["at"] + 1, F.char_length(t))))
    return F.when(F.size(spans) > 0, whole).otherwise(t)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every reported span masked and n_chars to match; clean rows unchanged, null texts stay null.

    Repeated rows are masked each; a null doc_id is an id like any other; an empty table gives no rows; all columns
    are kept, whatever their names.
    """
    got = scan(docs, carry=True).select("row", "spans").withColumn("text", F.col("row.text"))
    got = got.select("row", (F.size("spans") > 0).alias("hit"), masked("text", "spans").alias("masked"))
    own = {"text": F.col("masked"), "n_chars": F.when(F.col("hit"), F.char_length("masked").cast("long")).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {"text": F.col("masked")}
    return got.select(*[own.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
