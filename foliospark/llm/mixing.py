"""Mixing sources to target weights by entropy balancing (DataFrame functions only).

Every document gets a rate that is exponentially tilted by its size and bounded by the copy limit; a Newton
iteration over the (source, size) histogram solves the convex dual, one multiplier for each source, so that the
expected words of a source equal its target. Rates are then rounded into whole copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, n_words, packed_rows, small, stored

UNIT = 1_000_000  # rates are whole millionths, so that sums don't depend on their order
WEIGHTS = (5, 2, 1)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, cap: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row for each source.

    Sources in code-point order, null last, take the weights in turn. A target stops at ``cap`` times its
    source's size and the excess goes to the others by weight: the water level at which the capped targets add
    up is found in one sweep over sources ordered by capacity per weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights))
    t = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * cap)
    t = t.withColumn("ratio", F.col("cap") / F.col("weight"))
    sweep = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    up_to = sweep.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("total", F.sum("source_size").over(every) * F.lit(share))
    t = t.withColumn("filled", F.coalesce(F.sum("cap").over(up_to), F.lit(0))).withColumn("rest", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(up_to), F.lit(0)))
    t = t.withColumn("level", (F.col("total") - F.col("filled")) / F.col("rest"))
    t = t.withColumn("at", F.row_number().over(sweep))
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("at", "level"))).over(every)["level"]
    target = F.when(F.coalesce(level, F.lit(float("inf"))) >= F.col("ratio"), F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    return t.select("source", "source_size", target.alias("target"))


def balance(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, cap: int = 3, rows_per_bucket: int = 50_000, max_iterations: int = 60, tolerance: float = 1e-7) -> DataFrame:
    """doc_id, th (text hash), source, size, source_size, target, copies, taken for every row of ``docs``.

    ``copies`` is 0 to ``cap``; ``taken`` = copies * size. Sizes are word counts (null text: 0); a null source
    is a source of its own, last in order; rows that repeat in doc_id, source and size are counted before the
    shuffle; empty tables give no rows; other columns are not read. Sources without words get target 0 and
    documents without words no copies. All sums that decide are sums of integers, so reruns agree.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words("text").alias("size"), F.xxhash64("text").alias("th"))
    slim = stored(slim.groupBy("doc_id", "source", "size", "th").agg(F.count("*").alias("m")))
    n_buckets = max(16, -(-slim.count() // rows_per_bucket))
    bucket = F.pmod(F.xxhash64("doc_id", "th"), F.lit(n_buckets)).cast("int")
    slim = slim.withColumn("bucket", bucket)
    cells = stored(slim.groupBy("source", "size", "bucket").agg(F.sum("m").alias("rows")))
    hist = cells.groupBy("source", "size").agg(F.sum("rows").alias("n"))
    targets = source_targets(hist.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, cap)
    mean = hist.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.greatest(F.sum("n"), F.lit(1))).alias("mean"))
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    targets = stored(targets.alias("a").join(mean.alias("b"), same).select("a.*", F.greatest("mean", F.lit(1.0)).alias("mean")))
    hist = stored(hist.alias("a").join(targets.alias("b"), same).select("a.*", "target", "source_size", "mean"))

    state = solve(hist, targets, cap, max_iterations, tolerance)
    h = hist.alias("a").join(state.alias("b"), same).select("a.*", F.round(rate(F.col("size") / F.col("mean"), F.col("lam"), cap) * UNIT).cast("long").alias("r"))
    h = h.withColumn("r", F.when(F.col("target") >= F.col("source_size") * cap, F.lit(cap * UNIT)).when(F.col("target") <= 0, F.lit(0)).otherwise(F.col("r")))
    h = h.withColumn("r", F.when(F.col("size") > 0, F.col("r")).otherwise(F.lit(0)).cast("long"))
    groups = whole_copies(h, cap)

    keys = ["source", "size"]
    off = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row for each bucket
    cell = cells.withColumn("skip", F.coalesce(F.sum("rows").over(off), F.lit(0)))
    on = same & (F.col("a.size") == F.col("b.size"))
    cell = cell.alias("a").join(groups.alias("b"), on).select("a.*", "k", "n", "target", "source_size")
    rank = Window.partitionBy("source", "size", "bucket").orderBy(F.col("doc_id").asc_nulls_first(), "th").rowsBetween(Window.unboundedPreceding, -1)
    ranked = slim.withColumn("j0", F.coalesce(F.sum("m").over(rank), F.lit(0)))
    on &= F.col("a.bucket") == F.col("b.bucket")
    out = ranked.alias("a").join(cell.alias("b"), on).select("a.doc_id", "a.th", "a.source", "a.size", "source_size", "target", "k", "n", (F.col("skip") + F.col("j0")).alias("j0"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("i"))
    j = F.col("j0") + F.col("i")
    copies = F.expr("(j + 1) * k div n - j * k div n")
    return out.withColumn("j", j).withColumn("copies", copies.cast("int")).select("doc_id", "th", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, limit: int = BROADCAST_BYTES, **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (not at all for 0 copies).

    Null texts and texts without words have size 0 and get no copies; null sources are a source of their own; rows
    that repeat share their copies as evenly as can be; an empty table gives no rows; all columns are kept, whatever
    their names.
    """
    plan = balance(docs, **options).groupBy("doc_id", "th", "source").agg(F.sum("copies").cast("int").alias("k"), F.count("*").cast("int").alias("m"))
    plan = stored(plan.select(F.col("doc_id").alias("mix_id"), F.col("th").alias("mix_th"), F.col("source").alias("mix_source"), "k", "m"))
    side = small(plan, 24 + F.coalesce(F.octet_length("mix_source"), F.lit(0)), limit)
    rows = packed_rows(docs, id=F.col("doc_id").cast("long"), th=F.xxhash64("text"), source=F.col("source"))
    on = F.col("id").eqNullSafe(F.col("mix_id")) & (F.col("th") == F.col("mix_th")) & F.col("source").eqNullSafe(F.col("mix_source"))
    rows = rows.join(side, on)
    some = rows.filter("m = 1 AND k > 0").select("row", F.explode(F.expr("sequence(1, k)")))
    repeated = rows.filter("m > 1 AND k > 0").withColumn("j", F.row_number().over(Window.partitionBy("mix_id", "mix_th", "mix_source").orderBy(F.xxhash64(F.col("row").cast("string")))) - 1)
    repeated = repeated.withColumn("own", F.expr("(j + 1) * k div m - j * k div m")).filter("own > 0").select("row", F.explode(F.expr("sequence(1, cast(own AS int))")))
    return some.unionByName(repeated).select("row.*")


def rate(x, lam, cap: int):
    """Bounded exponential tilt: 1 at lam = 0, cap in the limit."""
    tilt = F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -lam * x)))
    return F.lit(float(cap)) / (F.lit(1.0) + F.lit(cap - 1.0) * tilt)


def solve(hist: DataFrame, targets: DataFrame, cap: int, max_iterations: int, tolerance: float) -> DataFrame:
    """(source, lam): safeguarded Newton steps; every step is one aggregation of the histogram by source.

    A step that leaves the bracket is replaced by its middle. A source is settled within ``tolerance`` of its
    target, or within the error that rates rounded to millionths can make (half a millionth of its size). The
    driver sees one number a step: whether a source whose target is strictly inside (0, cap * size) is unsettled. Steps
    that run out are an error.
    """
    free = (F.col("target") > 0) & (F.col("target") < F.col("source_size") * cap)
    state = stored(targets.filter(free).select("source", F.lit(0.0).alias("lam"), F.lit(-4096.0).alias("lo"), F.lit(4096.0).alias("hi"), F.lit(False).alias("settled")))
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    scale = F.lit(1e6)
    for _ in range(max_iterations):
        x = F.col("size") / F.col("mean")
        r = rate(x, F.col("lam"), cap)
        slope = r * (F.lit(1.0) - r / F.lit(float(cap))) * x
        got = hist.alias("a").join(state.alias("b"), same).groupBy("a.source").agg(
            F.first("lam").alias("lam"), F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.first("target").alias("target"), F.first("source_size").alias("whole"),
            (F.sum(F.round(r * scale).cast("decimal(38,0)") * F.col("size") * F.col("n")).cast("double") / scale).alias("f"),
            (F.sum(F.round(slope * scale).cast("decimal(38,0)") * F.col("size") * F.col("n")).cast("double") / scale).alias("d"),
        )
        got = got.withColumn("lo", F.when(F.col("f") < F.col("target"), F.col("lam")).otherwise(F.col("lo")))
        got = got.withColumn("hi", F.when(F.col("f") >= F.col("target"), F.col("lam")).otherwise(F.col("hi")))
        step = F.col("lam") + F.when(F.col("d") > 0, (F.col("target") - F.col("f")) / F.col("d"))
        inside = (step > F.col("lo")) & (step < F.col("hi"))
        middle = (F.col("lo") + F.col("hi")) / 2
        narrow = F.when((F.col("lo") > -4096) & (F.col("hi") < 4096), middle).when(F.col("lo") <= -4096, F.col("lam") * 2 - 1).otherwise(F.col("lam") * 2 + 1)
        settled = F.abs(F.col("f") - F.col("target")) <= F.greatest(F.col("target") * tolerance, F.col("whole") / (2 * scale))
        next_lam = F.when(settled, F.col("lam")).when(inside & (F.abs(step - F.col("lam")) < 4), step).otherwise(narrow)
        state = stored(got.select("source", next_lam.alias("lam"), "lo", "hi", settled.alias("settled")))
        if state.filter("NOT settled").isEmpty():
            break
    else:
        raise RuntimeError(f"source rates did not settle in {max_iterations} steps")
    return targets.select("source").alias("a").join(state.alias("b"), same, "left").select("a.source", F.coalesce("lam", F.lit(0.0)).alias("lam"))


def whole_copies(h: DataFrame, cap: int) -> DataFrame:
    """Adds k, the copies of all n documents of one (source, size), 0 to cap * n.

    Running rates in size order are cut at whole numbers, so neighbours in size make up for each other; then one
    sweep from the largest size down spends what is still missing from the source's target (or takes back what is
    too much). A source's groups number at most the words of its longest document.
    """
    run = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("c1", F.sum(F.col("n") * F.col("r")).over(run)).withColumn("c0", F.col("c1") - F.col("n") * F.col("r"))
    h = h.withColumn("k", F.expr(f"(c1 + {UNIT // 2}) div {UNIT} - (c0 + {UNIT // 2}) div {UNIT}"))
    h = h.withColumn("k", F.when(F.col("size") > 0, F.least(F.col("k"), F.col("n") * cap)).otherwise(F.lit(0)))
    by = h.groupBy("source").agg(
        F.round(F.first("target")).cast("long").alias("target"), F.sum(F.col("k") * F.col("size")).alias("took"),
        F.reverse(F.array_sort(F.collect_list(F.struct("size", "n", "k")))).alias("g"),
    )
    sweep = f"""aggregate(filter(g, e -> e.size > 0), struct(target - took AS miss, cast(array() AS array<struct<size: bigint, more: bigint>>) AS put),
      (a, e) -> CASE
        WHEN a.miss > 0 AND e.size <= a.miss AND e.k < e.n * {cap} THEN struct(a.miss - least(e.n * {cap} - e.k, a.miss div e.size) * e.size AS miss, concat(a.put, array(struct(e.size AS size, least(e.n * {cap} - e.k, a.miss div e.size) AS more))) AS put)
        WHEN a.miss < 0 AND e.size <= -a.miss AND e.k > 0 THEN struct(a.miss + least(e.k, -a.miss div e.size) * e.size AS miss, concat(a.put, array(struct(e.size AS size, -least(e.k, -a.miss div e.size) AS more))) AS put)
        ELSE a END).put"""
    fixes = by.select("source", F.explode(F.expr(sweep)).alias("p")).select("source", "p.size", "p.more")
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.size") == F.col("b.size"))
    return h.alias("a").join(fixes.alias("b"), same, "left").select("a.source", "a.size", "n", "target", "source_size", (F.col("k") + F.coalesce("more", F.lit(0))).alias("k"))
