"""Global order statistics without a single-partition window.

``Window.orderBy`` with no partition key moves every row into one task.  The
primitives here split the order into buckets first, in the same way at every
size:

* :func:`prefix_sums` — running sums over an ordered table: approximate
  quantile cut points define ~``buckets`` value ranges, per-bucket totals
  (a table of ``buckets`` rows) give each bucket's offset, and the running
  sum is computed **within** each bucket in parallel.
* :func:`with_global_index` — a dense 0-based row index over a unique order,
  by a two-level rank: rows get a bucket that is monotone in the order, the
  small table of bucket counts gives the offsets, rows are numbered inside
  their bucket.  The input is materialised once; everything else reads that.
* :func:`linear_quantiles` / :func:`discrete_quantiles` — exact quantiles from
  the rows themselves: a sketch gives brackets around the wanted ranks, two
  passes narrow them by counting, and only the values left in a bracket are
  ordered.
* :func:`locate_quantile` — exact discrete quantile from a value→count
  table, touching only the one bucket that holds the answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from domus.session import cut_lineage

DEFAULT_BUCKETS = 128
ROWS_PER_BUCKET = 250_000  # rows numbered in one task
PREFIX_ROWS = 1_000_000    # rows of a running sum in one task (DEFAULT_BUCKETS tasks at most)
MAX_CUTS = 512             # cut points written into an expression
STRING_PIECES = 6          # pieces of a string that buckets look at
SKETCH_STEPS = 1024        # first bracket: this share of the rows on either side of a rank
NARROW_STEPS = 256         # second bracket, inside the first
SKETCH_ACCURACY = 10_000
WHOLE_GROUP = 10_000       # below, the sketch is exact but too short for a margin: the bracket is the group


def cut_points(df: DataFrame, col: str, buckets: int = DEFAULT_BUCKETS,
               accuracy: int = 10000, group_cols: list[str] | None = None) -> DataFrame:
    """``buckets-1`` approximate quantile cut points (one row, or one row per
    group)."""
    probs = [i / buckets for i in range(1, buckets)]
    agg = F.percentile_approx(F.col(col), probs, accuracy).alias("_cuts")  # in the column's own type
    return df.groupBy(*group_cols).agg(agg) if group_cols else df.agg(agg)


def assign_bucket(df: DataFrame, col: str, cuts: DataFrame, out: str = "_bucket",
                  descending: bool = False, buckets: int = DEFAULT_BUCKETS,
                  group_cols: list[str] | None = None) -> DataFrame:
    """Bucket = number of cut points strictly below the value (monotone in the
    value; equal values share a bucket).  Without groups the cut table is one
    row; with groups it has one row per group and is broadcast only if small."""
    if group_cols:
        j = _join_groups(df, cuts, group_cols)
    else:
        j = df.crossJoin(F.broadcast(cuts))
    b = F.coalesce(F.expr(f"size(filter(_cuts, c -> c < `{col}`))"), F.lit(0))
    if descending:
        b = F.lit(buckets) - b
    return j.withColumn(out, b).drop("_cuts")


def _join_groups(df: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Join one row per group, NULL groups included, size-checked."""
    from domus.operators.joins import small_side

    r = side.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = [df[k].eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return df.join(small_side(r), cond).drop(*[f"_r_{k}" for k in keys])


def prefix_sums(df: DataFrame, order_col: str, sum_cols: list[str], descending: bool = False,
                tie_cols: list[str] | None = None, prefix: str = "cum_",
                buckets: int | None = None, exclusive: bool = False,
                group_cols: list[str] | None = None, with_next: bool = False, ready: bool = False) -> DataFrame:
    """Add ``cum_<c>`` = running sum of ``c`` in ``order_col`` order (inclusive
    of the current row unless ``exclusive``), per ``group_cols`` if given.
    The table is materialised once (``ready``: it already is); the number of
    buckets follows its size unless given.
    ``order_col`` + ``tie_cols`` should be unique per row within a group
    (typically a table of distinct values).  ``with_next`` also adds
    ``next_<order_col>``, the following value in the order (NULL at the end).
    """
    g = list(group_cols or [])
    ocol = F.col(order_col).desc() if descending else F.col(order_col).asc()
    orders = [ocol] + [F.col(t) for t in (tie_cols or [])]
    upper = -1 if exclusive else 0
    df = df if ready else cut_lineage(df)
    if buckets is None:
        buckets = max(1, min(DEFAULT_BUCKETS, -(-df.count() // PREFIX_ROWS)))
    if buckets > 1:
        cuts = cut_points(df, order_col, buckets, group_cols=g)
        bdf = assign_bucket(df, order_col, cuts, descending=descending, buckets=buckets, group_cols=g)
    else:
        bdf = df.withColumn("_bucket", F.lit(0))  # one bucket, nothing before it
    aggs = [F.sum(c).alias(f"_t_{c}") for c in sum_cols]
    if with_next:
        first = F.max(order_col) if descending else F.min(order_col)
        aggs.append(first.alias("_first"))
    totals = bdf.groupBy(*g, "_bucket").agg(*aggs)
    # ``totals`` has at most ``buckets + 1`` rows per group: a window over it
    # (partitioned by group only) is bounded.
    over = (Window.partitionBy(*g) if g else Window).orderBy("_bucket")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols]
    if with_next:
        cols.append(F.lead("_first").over(over).alias("_next_bucket_first"))
    offsets = totals.select(*g, "_bucket", *cols)
    inside = Window.partitionBy(*g, "_bucket").orderBy(*orders)
    within = inside.rowsBetween(Window.unboundedPreceding, upper)
    if buckets > 1:
        out = _join_groups(bdf, offsets, [*g, "_bucket"])
    else:
        first_next = {"_next_bucket_first": F.lit(None).cast(df.schema[order_col].dataType)} if with_next else {}
        out = bdf.withColumns({f"_o_{c}": F.lit(0) for c in sum_cols} | first_next)
    out = out.withColumns({
        f"{prefix}{c}": F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(within), F.lit(0))
        for c in sum_cols
    })
    if with_next:
        out = out.withColumn(f"next_{order_col}",
                             F.coalesce(F.lead(order_col).over(inside), F.col("_next_bucket_first")))
        out = out.drop("_next_bucket_first")
    return out.drop("_bucket", *[f"_o_{c}" for c in sum_cols])


def _levels(df: DataFrame, order_cols: list[str]) -> list[Column]:
    """The order columns as expressions with quantile cut points.  A string
    counts by pieces of 6 bytes and their length; beyond ``STRING_PIECES`` of
    them (by the longest string) it is the last level, as equal pieces then no
    longer mean equal strings."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in order_cols}
    texts = [c for c in order_cols if kinds[c] == "string"]
    longest = df.agg(*[F.max(F.octet_length(c)).alias(c) for c in texts]).first().asDict() if texts else {}
    out = []
    for c in order_cols:
        if kinds[c] == "string":
            pieces = -(-(longest[c] or 0) // 6) or 1
            for k in range(min(pieces, STRING_PIECES)):
                part = F.substring(F.encode(F.col(c), "UTF-8"), 6 * k + 1, 6)
                out.append(F.conv(F.rpad(F.hex(part), 12, "0"), 16, 10).cast("long") * 8 + F.octet_length(part))
            if pieces > STRING_PIECES:
                break
        elif kinds[c] == "boolean":
            out.append(F.col(c).cast("int"))
        elif kinds[c] in ("double", "float"):  # NaN comes last
            out += [F.when(F.col(c).isNotNull(), F.isnan(c).cast("int")), F.when(F.isnan(c), F.lit(0.0)).otherwise(F.col(c))]
        else:
            out.append(F.col(c))
    return out


def _place(x: Column, cuts: list) -> Column:
    """Number of the (distinct, ordered) cut points below ``x``, as a decision tree."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x <= F.lit(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(cuts))


def _less_than(x: Column):
    return lambda c: c < x


def order_buckets(df: DataFrame, levels: list[Column], buckets: int, accuracy: int = SKETCH_ACCURACY) -> list[Column]:
    """Columns whose order agrees with that of the rows by ``levels`` and
    which split the rows into about ``buckets`` groups.

    The first column is cut at approximate quantiles.  A value that takes
    several quantiles (a hot one) is split by the next column, cut at the
    quantiles of that value's rows, and so on.  ``df`` is read once per level;
    at most ``buckets`` cut points reach the driver per level."""
    keys: list[Column] = []
    paths = {(): buckets}  # values of the levels so far that are split further -> buckets
    for depth, x in enumerate(levels):
        names = [f"_p{i}" for i in range(depth)]
        at = F.lit(True)
        if depth:
            at = F.lit(False)
            for path in paths:
                same = F.lit(True)
                for e, v in zip(levels, path):
                    same = same & (e.isNull() if v is None else e == F.lit(v))
                at = at | F.coalesce(same, F.lit(False))
        most = max(paths.values())
        probs = [i / most for i in range(1, most)]
        rows = (df.where(at).groupBy(*[e.alias(n) for e, n in zip(levels, names)]).agg(
            F.percentile_approx(x, probs, accuracy).alias("cuts"), F.count(F.lit(1)).alias("n"),
            F.count(F.when(x.isNull(), 1)).alias("nulls")).collect() if probs else [])
        key, further = F.lit(-2 if depth else 0), {}
        for r in rows:
            path = tuple(r[n] for n in names)
            own = paths[path]
            step = max(1, most // own)
            cuts = list(r["cuts"] or [])[step - 1::step]
            here = F.when(x.isNull(), F.lit(-1)).otherwise(_place(x, sorted(set(cuts))))
            if depth:
                same = F.lit(True)
                for e, v in zip(levels, path):
                    same = same & (e.isNull() if v is None else e == F.lit(v))
                key = F.when(F.coalesce(same, F.lit(False)), here).otherwise(key)
            else:
                key = here
            for v in set(cuts):
                if cuts.count(v) > 1:
                    further[(*path, v)] = cuts.count(v)
            if r["nulls"] * own > 2 * r["n"]:
                further[(*path, None)] = int(r["nulls"] * own // r["n"])
        keys.append(key.cast("int"))
        if not further:
            break
        paths = further
    return keys


def with_global_index(df: DataFrame, order_cols: list[str], out: str = "row_index",
                      partitions: int | None = None, total: str | None = None,
                      bucket: str | None = None) -> DataFrame:
    """Dense 0-based index of each row in ``order_cols`` order (must be a
    unique order — append an id as the last column), NULLs first.  ``total``
    also adds the row count under that name, ``bucket`` the number of the
    row's bucket.  ``df`` is computed once, into the checkpoint folder."""
    return indexed(df, order_cols, out, partitions, total, bucket)[0]


def indexed(df: DataFrame, order_cols: list[str], out: str = "row_index", partitions: int | None = None,
            total: str | None = None, bucket: str | None = None) -> tuple[DataFrame, int]:
    """The frame of :func:`with_global_index` and its number of rows."""
    kept = cut_lineage(df)
    n = kept.count()  # of the materialised frame
    buckets = partitions or max(1, -(-n // ROWS_PER_BUCKET))
    levels = _levels(kept, order_cols)
    keys = [f"_k{i}" for i in range(len(levels))]
    cols = order_buckets(kept, levels, min(buckets, MAX_CUTS)) if n else []
    cols += [F.lit(-2)] * (len(keys) - len(cols))
    keyed = kept.withColumns(dict(zip(keys, cols)))
    if buckets > MAX_CUTS:
        # more buckets than an expression should hold: each is cut once more at the level
        # it was cut last, the cut points joined as a table of one row per bucket
        parts = min(MAX_CUTS, -(-buckets // MAX_CUTS))
        probs = [i / parts for i in range(1, parts)]
        last = [(F.col(k) >= -1) & (F.col(after) < -1 if after else F.lit(True)) for k, after in zip(keys, [*keys[1:], None])]
        fine = keyed.groupBy(*keys).agg(*[F.percentile_approx(F.when(own, x), probs, SKETCH_ACCURACY).alias(f"_cuts{i}")
                                          for i, (own, x) in enumerate(zip(last, levels))])
        keyed = keyed.join(F.broadcast(fine), keys)
        below = [F.when(own, F.array_size(F.filter(f"_cuts{i}", _less_than(x)))) for i, (own, x) in enumerate(zip(last, levels))]
        keyed = keyed.withColumn("_fine", F.coalesce(*below, F.lit(0))).drop(*[f"_cuts{i}" for i in range(len(keys))])
        keys = [*keys, "_fine"]
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))  # one row per bucket
    order = Window.orderBy(*keys)
    offsets = counts.select(*[F.col(k).alias(f"_o{k}") for k in keys], (F.row_number().over(order) - 1).alias("_bucket"),
                            F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys).orderBy(*order_cols)
    res = keyed.withColumn("_row", F.row_number().over(inside) - 1)
    res = res.join(F.broadcast(offsets), [F.col(k) == F.col(f"_o{k}") for k in keys])  # one row per bucket
    cols = [*[F.col(c) for c in df.columns], (F.col("_off") + F.col("_row")).alias(out)]
    if total:
        cols.append(F.lit(n).cast("long").alias(total))
    if bucket:
        cols.append(F.col("_bucket").alias(bucket))
    return res.select(*cols), n


def locate_quantile(value_counts: DataFrame, value_col: str, count_col: str, q: float,
                    buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Exact discrete quantile: the smallest value whose cumulative count
    reaches ``q·N`` (``percentile_disc`` semantics).

    ``value_counts`` has one row per distinct value.  Only the bucket that
    contains the target rank is ordered row by row.  Returns one row
    ``(value)``; NULL when the input is empty.
    """
    cuts = cut_points(value_counts, value_col, buckets)
    bdf = assign_bucket(value_counts, value_col, cuts, buckets=buckets)
    totals = bdf.groupBy("_bucket").agg(F.sum(count_col).alias("_t"))
    all_rows = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # percentile_disc: the first value whose cumulative share reaches q
    ranked = totals.select(
        "_bucket", "_t",
        F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"),
        F.sum("_t").over(all_rows).alias("_all"))
    share = (F.col("_before") + F.col("_t")) / F.col("_all")
    pick = (ranked.where(share >= F.lit(float(q))).agg(F.min_by(F.struct("_bucket", "_before", "_all"), "_bucket").alias("p"))
            .select("p.*").where(F.col("_bucket").isNotNull()))
    inside = bdf.join(F.broadcast(pick), "_bucket")  # one bucket survives
    w = (Window.partitionBy("_bucket").orderBy(F.col(value_col))
         .rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("_cum", F.sum(count_col).over(w))
    reached = (F.col("_before") + F.col("_cum")) / F.col("_all") >= F.lit(float(q))
    hit = inside.where(reached).agg(F.min(value_col).alias("value"))
    return hit


def ranked_brackets(d: DataFrame, value: str, qs: list[float], g: list[str]) -> DataFrame:
    """(group…, q, _n, value, _c, _cum): the distinct values around the ranks of
    ``qs`` in each group, with their counts and the rows up to and including
    them.  ``value`` has no NULLs.

    A first sketch brackets each rank; a second one inside the bracket, with
    exact counts of what lies below it, narrows it; the values left are counted
    and ordered.  Brackets hold the neighbours of the rank on both sides."""
    v = F.col(value)
    each = range(len(qs))

    def pick(grid: str, steps: int, place: Column) -> tuple[Column, Column]:
        """Neighbours of a place (0..1) on the grid, one step further out."""
        i = F.floor(place * steps).cast("int")
        return (F.element_at(grid, F.greatest(i - 1, F.lit(0)) + 1), F.element_at(grid, F.least(i + 2, F.lit(steps)) + 1))

    def grid(x: Column, steps: int) -> Column:
        return F.percentile_approx(x, [i / steps for i in range(steps + 1)], SKETCH_ACCURACY)

    first = d.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), grid(v, SKETCH_STEPS).alias("_grid"))
    whole = F.col("_n") <= WHOLE_GROUP
    ends = (F.element_at("_grid", 1), F.element_at("_grid", -1))
    for i, q in enumerate(qs):
        lo, hi = pick("_grid", SKETCH_STEPS, F.lit(float(q)))
        first = first.withColumns({f"_a{i}": F.when(whole, ends[0]).otherwise(lo), f"_b{i}": F.when(whole, ends[1]).otherwise(hi)})
    first = first.drop("_grid")

    def within(table: DataFrame) -> DataFrame:
        return _join_groups(d, table, g) if g else d.crossJoin(F.broadcast(table))  # one row

    # the counts below a bracket and inside it are exact; the grid inside only narrows
    inside = [(v >= F.col(f"_a{i}")) & (v <= F.col(f"_b{i}")) for i in each]
    aggs = [F.sum(F.when(v < F.col(f"_a{i}"), 1).otherwise(0)).alias(f"_below{i}") for i in each]
    aggs += [F.count(F.when(inside[i], 1)).alias(f"_m{i}") for i in each]
    aggs += [grid(F.when(inside[i], v), NARROW_STEPS).alias(f"_grid{i}") for i in each]
    second = within(first).groupBy(*g, *first.drop(*g).columns).agg(*aggs)
    for i, q in enumerate(qs):
        place = F.try_divide((F.col("_n") - 1) * F.lit(float(q)) - F.col(f"_below{i}"), F.col(f"_m{i}"))
        place = F.least(F.greatest(place, F.lit(0.0)), F.lit(1.0))
        lo, hi = pick(f"_grid{i}", NARROW_STEPS, place)
        small = F.col(f"_m{i}") <= WHOLE_GROUP
        second = second.withColumns({f"_a{i}": F.when(small, F.col(f"_a{i}")).otherwise(lo), f"_b{i}": F.when(small, F.col(f"_b{i}")).otherwise(hi)})
    second = second.select(*g, "_n", *[f"_{x}{i}" for i in each for x in "ab"])
    # rows below a bracket count together, as NULL, which comes first
    at = F.array(*[F.when(v <= F.col(f"_b{i}"), F.struct(F.lit(float(q)).alias("q"), F.when(v >= F.col(f"_a{i}"), v).alias(value)))
                   for i, q in enumerate(qs)])
    near = within(second).select(*g, "_n", at.alias("_at")).select(*g, "_n", F.inline(F.filter("_at", lambda x: x.isNotNull())))
    near = near.groupBy(*g, "q", "_n", value).agg(F.count(F.lit(1)).alias("_c"))
    up = Window.partitionBy(*g, "q").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return near.withColumn("_cum", F.sum("_c").over(up)).where(F.col(value).isNotNull())


def linear_quantiles(df: DataFrame, value_col: str, qs: list[float], group_cols: list[str] | None = None,
                     out: str = "value") -> DataFrame:
    """Exact linearly-interpolated quantiles per group without holding a
    group's values in one buffer → one row per (group…, q): position
    ``p = q·(n-1)`` (0-based) between the values of the ranks ``floor(p)`` and
    ``ceil(p)``."""
    g = list(group_cols or [])
    d = df.where(F.col(value_col).isNotNull()).select(*g, F.col(value_col).cast("double").alias("_v"))
    near = ranked_brackets(d, "_v", qs, g)
    pos = (F.col("_n") - 1) * F.col("q")
    at = lambda rank: F.min(F.when(F.col("_cum") > rank, F.col("_v")))
    res = near.groupBy(*g, "q", "_n").agg(at(F.floor(pos)).alias("_lo"), at(F.ceil(pos)).alias("_hi"))
    return res.select(*g, "q", (F.col("_lo") + (pos - F.floor(pos)) * (F.col("_hi") - F.col("_lo"))).alias(out))


def discrete_quantiles(df: DataFrame, value_col: str, qs: list[float], group_cols: list[str] | None = None,
                       out: str = "value") -> DataFrame:
    """Exact discrete quantiles (``percentile_disc``) per group → one row per
    (group…, q): the smallest value whose cumulative share reaches q."""
    g = list(group_cols or [])
    d = df.where(F.col(value_col).isNotNull()).select(*g, F.col(value_col).alias("_v"))
    near = ranked_brackets(d, "_v", qs, g)
    reached = F.col("_cum") / F.col("_n") >= F.col("q")
    return near.groupBy(*g, "q").agg(F.min(F.when(reached, F.col("_v"))).alias(out))
