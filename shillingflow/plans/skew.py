"""Plans that stay balanced when one key holds a large share of the rows.

A key is *crowded* above ``HOT_ROWS`` rows. Of these the ``MOST_HOT`` largest are treated apart, which is
the size bound behind every ``broadcast`` here, whatever the input: any other key holds less than one
``MOST_HOT``-th of all rows.
"""

from __future__ import annotations

from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_out

HOT_ROWS = 2_000_000
MOST_HOT = 20_000
SALTS = 64
SLOT_REACHES = 8
SMALL, FINER = 1_000_000, 4096
FEW_ROWS, PART_ROWS = 50_000, 1_000_000


def _largest(counted: DataFrame, size: str, keys: list[str], hot_rows: int, most: int = MOST_HOT) -> DataFrame:
    """The crowded keys' rows, at most ``most`` of them."""
    return counted.filter(F.col(size) > hot_rows).orderBy(F.desc(size), *keys).limit(most)


def profile_join(rows: DataFrame, profile: DataFrame, keys: list[str], size: str, spread: str,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join of ``rows`` to one-row-per-key ``profile`` whose ``size`` column counts rows.

    Crowded keys take their values from a broadcast; their rows are salted by ``spread`` so the
    shuffle that serves the remaining keys does not pile them into one task. Both halves of the
    profile differ only after its final aggregate, so the shuffle under it is computed once.
    """
    names = [c for c in profile.columns if c not in keys]
    hot = _largest(profile, size, keys, hot_rows).select(*keys, *[F.col(c).alias(f"_hot_{c}") for c in names])
    # always 0, but not a literal: a constant would be folded out of the join key
    zero = F.pmod(F.xxhash64(*keys), F.lit(1))
    cold = profile.withColumn("_salt", zero.cast("bigint"))  # rows of a hot key have another salt and don't meet theirs
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt",
        F.when(F.col(f"_hot_{size}").isNotNull(), F.pmod(F.xxhash64(spread), F.lit(SALTS)) + 1)
        # a null key finds no profile by equality, so its rows may go anywhere
        .when(reduce(or_, [F.col(k).isNull() for k in keys]), F.pmod(F.xxhash64(spread), F.lit(SALTS)) + 1)
        .otherwise(0),
    )
    joined = salted.join(cold, keys + ["_salt"], "left")
    return joined.select(
        *rows.columns, *[F.coalesce(f"_hot_{c}", c).alias(c) for c in names]
    )


def evenly(rows: DataFrame, n: int) -> DataFrame:
    """``n`` rows in parts of one size, one for each core at least, for work that costs far more per row than moving it.

    Joins leave parts by bytes, few and of any size. Fewer than ``FEW_ROWS`` rows stay as they are."""
    if n < FEW_ROWS:
        return rows
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // PART_ROWS)))


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality: null is a key like any other, and often a crowded one."""
    return reduce(and_, [left[k].eqNullSafe(right[k]) for k in keys])


def ordered_sequence(df: DataFrame, keys: list[str], order: list[Column], levels: list[Column],
                     out: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``row_number`` per key without putting a crowded key into one task.

    ``levels`` are bigint expressions that refine the order: rows sorted by ``order`` are also
    sorted by ``levels``. Rows of a crowded key are numbered in pieces that agree in all levels; the
    number of a row is its number inside the piece plus the counts of the earlier pieces.

    The crowded keys are counted once, over the key columns alone, and written. Without any, one window does;
    otherwise uncrowded rows get that window, and crowded rows are read twice, for their counts by all
    levels and to be numbered.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")
    counted = df.groupBy(*keys).count()
    crowded_keys = write_out(_largest(counted, "count", keys, hot_rows).select(*keys), "crowded")
    if crowded_keys.isEmpty():
        return df.withColumn(out, number)
    crowded_keys = F.broadcast(crowded_keys)
    plain = df.join(crowded_keys, same_keys(df, crowded_keys, keys), "left_anti").withColumn(out, number)
    hot = df.join(crowded_keys, same_keys(df, crowded_keys, keys), "left_semi")
    return plain.unionByName(_pieced_sequence(hot, keys, order, levels, out))


def _pieced_sequence(df: DataFrame, keys: list[str], order: list[Column], levels: list[Column], out: str) -> DataFrame:
    """Pieces are counted once; one window runs over the first level's groups of a key, one over the pieces of a group."""
    names = [f"_piece{i}" for i in range(len(levels))]
    pieces = df.withColumns({n: F.coalesce(c, F.lit(-2)).cast("bigint") for n, c in zip(names, levels)})
    group, full = [*keys, names[0]], [*keys, *names]
    counts = pieces.groupBy(*full).agg(F.count("*").alias("_n"))

    def earlier(part: list[str], by: list[str], value: str) -> Column:
        window = Window.partitionBy(*part).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(window), F.lit(0))

    groups = counts.groupBy(*group).agg(F.sum("_n").alias("_n")).select(*group, earlier(keys, names[:1], "_n").alias("_before"))
    within = counts.select(*full, (earlier(group, names[1:], "_n") if names[1:] else F.lit(0)).alias("_within"))
    offsets = within.join(groups, same_keys(within, groups, group)).select(within["*"], "_before")
    numbered = pieces.withColumn("_in_piece", F.row_number().over(Window.partitionBy(*full).orderBy(*order)))
    return numbered.join(offsets, same_keys(numbered, offsets, full)).select(
        *[numbered[c] for c in df.columns], (F.col("_in_piece") + F.col("_within") + F.col("_before")).cast("bigint").alias(out))


def slotted_sums(df: DataFrame, keys: list[str], time: str, reach: int,
                 frames: dict[str, tuple[str, int, int]]) -> DataFrame:
    """Range-frame sums over an integer ``time`` without one partition per whole key.

    ``frames`` maps an output name to (value column, first offset, last offset), offsets being at
    most ``reach`` back. Time is cut into slots of several ``reach``; rows near the end of a slot
    also visit the next one, so a frame never leaves its partition.
    """
    length = reach * SLOT_REACHES
    near_end = F.pmod(F.col(time), F.lit(length)) >= length - reach
    shifts = F.when(near_end, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    slots = df.withColumn("_shift", F.explode(shifts)).withColumn(
        "_slot", F.floor(F.col(time) / length) + F.col("_shift")
    )
    by_time = Window.partitionBy(*keys, "_slot").orderBy(time)
    for out, (value, first, last) in frames.items():
        slots = slots.withColumn(out, F.sum(value).over(by_time.rangeBetween(first, last)))
    return slots.filter("_shift = 0").drop("_shift", "_slot")


def trailing_counts(df: DataFrame, keys: list[str], ts: str, seconds: int, out: str) -> DataFrame:
    """Rows per key within the last ``seconds`` before each distinct instant, that instant included.

    Rows of one key and instant are counted first, so a window never holds more rows than there
    are distinct instants in a slot and the stretch before it. Returns keys, ``ts``, ``rows_at`` and ``out``.
    """
    return trailing_sums(df.groupBy(*keys, ts).agg(F.count("*").alias("rows_at")), keys, ts, seconds, out)


def trailing_sums(at: DataFrame, keys: list[str], ts: str, seconds: int, out: str) -> DataFrame:
    """As ``trailing_counts`` for rows that are already counted per key and instant."""
    span = seconds * 1_000_000
    timed = at.withColumn("_micros", F.unix_micros(F.col(ts).cast("timestamp")))
    return slotted_sums(timed, keys, "_micros", span, {out: ("rows_at", -(span - 1), 0)}).drop("_micros")


def _value_bucket(v: Column) -> Column:
    """Order-preserving bucket of a double: 1024 per power of two, at most a few million overall."""
    size = F.floor(F.log2(F.abs(v)) * 1024) + 1_200_000
    return F.when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size).cast("bigint")


def top_rows(df: DataFrame, value: str, ties: list[str], k: int) -> DataFrame:
    """The ``k`` largest rows when ``k`` is large.

    A plain sort-and-limit sends ``k`` rows per task to one task. Here a histogram gives a lower
    bound for the wanted values first, so little more than ``k`` rows are sorted.
    """
    bucket = _value_bucket(F.col(value).cast("double"))
    larger = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    histogram = df.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_n"))
    cutoff = (
        histogram.withColumn("_above", F.coalesce(F.sum("_n").over(larger), F.lit(0)))
        .filter(F.col("_above") < k).agg(F.min("_bucket")).scalar()
    )
    return df.filter(bucket >= cutoff).orderBy(F.desc(value), *ties).limit(k)


def _placed(counts: DataFrame, by: list[str]) -> DataFrame:
    """Ranks of the distinct values of each bucket: ``_start`` (its first row's) and ``_end``."""
    inside = Window.partitionBy(*by, "_bucket", "_before").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    return counts.withColumn("_start", start).withColumn("_end", F.col("_start") + F.col("_n"))


def _refined(rows: DataFrame, targets: DataFrame, by: list[str], ranks: list[Column], small: int) -> DataFrame:
    """Distinct values with their counts, in buckets that hold a wanted rank and at most ``small`` values.

    Buckets that are larger are cut into ``FINER`` ranges between their least and greatest value, again and
    again: ranges are ordered like the values whatever the rounding, so the result stays exact. Only their
    counts per range meet in one task.
    """
    counts = rows.join(targets.drop("_in_bucket"), [*by, "_bucket"]).groupBy(*by, "_bucket", "_v", "_before", "_total").agg(F.sum("_n").alias("_n"))
    if targets.filter(F.col("_in_bucket") > small).isEmpty():  # so many rows hold at most as many values
        return counts
    counts, done = write_out(counts, "quantile-values"), []
    group = [*by, "_bucket", "_before"]
    while True:
        sizes = counts.groupBy(*group).agg(F.count(F.lit(1)).alias("_values"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        large = sizes.filter(F.col("_values") > small)
        met = counts.join(large.withColumnsRenamed({c: f"_of{c}" for c in group}), reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in group]), "left")
        done.append(met.filter("_values is null").select(*counts.columns))
        if large.isEmpty():
            return reduce(DataFrame.unionByName, done)
        # subtraction and division by a positive width keep the order of the values
        part = F.least(F.floor((F.col("_v") - F.col("_low")) / ((F.col("_high") - F.col("_low")) / FINER)), F.lit(FINER - 1)).cast("bigint")
        cut = write_out(met.filter("_values is not null").select(*counts.columns, part.alias("_part")), "quantile-parts")
        parts = cut.groupBy(*group, "_part", "_total").agg(F.sum("_n").alias("_in"))
        start = F.col("_before") + F.coalesce(F.sum("_in").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        parts = parts.withColumn("_start", start)
        wanted = reduce(or_, [(r >= F.col("_start")) & (r < F.col("_start") + F.col("_in")) for r in ranks])
        parts = parts.filter(wanted).select(*[F.col(c).alias(f"_of{c}") for c in [*group, "_part"]], "_start")
        chosen = cut.join(parts, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in [*group, "_part"]]))
        counts = write_out(chosen.select(*by, "_bucket", "_v", F.col("_start").alias("_before"), "_total", "_n"), "quantile-values")


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: list[str] | None = None, small: int = SMALL) -> DataFrame:
    """Exact interpolated quantiles without gathering the values of a group in one task.

    Rows are counted in coarse ordered buckets, and only the buckets that hold a wanted rank are
    looked at value by value. Over the whole frame the values themselves are never shuffled;
    ``df`` is read twice. Per group the distinct values are counted once and shared. A bucket of more than
    ``small`` distinct values is refined first, so no task orders more than that.
    """
    by = by or []
    rows = (
        df.select(*by, F.col(value).cast("double").alias("_v")).filter("_v is not null")
        .withColumn("_bucket", _value_bucket(F.col("_v")))
    )
    if by:
        rows = rows.groupBy(*by, "_bucket", "_v").agg(F.count("*").alias("_n"))
    else:
        rows = rows.withColumn("_n", F.lit(1).cast("bigint"))
    groups = Window.partitionBy(*by)
    run = groups.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    histogram = (
        rows.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_in_bucket"))
        .withColumn("_before", F.coalesce(F.sum("_in_bucket").over(run), F.lit(0)))
        .withColumn("_total", F.sum("_in_bucket").over(groups))
    )

    def low(p: float) -> Column:
        return F.floor(F.lit(p) * (F.col("_total") - 1))

    def high(p: float) -> Column:
        return F.ceil(F.lit(p) * (F.col("_total") - 1))

    ranks = [f(p) for p in probs.values() for f in (low, high)]
    wanted = reduce(
        lambda a, b: a | b,
        [(r >= F.col("_before")) & (r < F.col("_before") + F.col("_in_bucket")) for r in ranks],
    )
    targets = histogram.filter(wanted).select(*by, "_bucket", "_before", "_total", "_in_bucket")
    if not by:
        targets = F.broadcast(targets)  # at most two buckets per probability
    values = _placed(_refined(rows, targets, by, ranks, small), by)

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_start")) & (rank < F.col("_end")), F.col("_v")))

    picked = values.groupBy(*by).agg(
        F.max("_total").alias("_total"),
        *[at(low(p)).alias(f"_lo_{name}") for name, p in probs.items()],
        *[at(high(p)).alias(f"_hi_{name}") for name, p in probs.items()],
    )

    def interpolate(name: str, p: float) -> Column:
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return (lo + (hi - lo) * (F.lit(p) * (F.col("_total") - 1) - low(p))).alias(name)

    return picked.select(*by, *[interpolate(n, p) for n, p in probs.items()])
