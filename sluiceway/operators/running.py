"""Running sums over a total order without moving all rows to one task.

The order is cut into slices that are plain arithmetic on the order columns, so a row's slice never depends on
how Spark happened to partition it: a retried task or a second evaluation gives the same slice. Slice totals
are a map-side combined aggregate; their prefix sum starts the counters of each slice, and an ordinary window
inside the slice does the rest. One shuffle of the rows, keyed by slice.

Slices that come out heavy (many rows at nearly the same time, or one time holding a third of the table) are
cut again on a finer scale, down to the next order column where the earlier ones are constant.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.session import fresh_path

# What a slice aims at; ``rows_per_slice`` of the operators overrides it where rows are very wide or very narrow.
ROWS_PER_SLICE = 1_000_000
# The first grid is finer than the slices asked for: that costs only more offset rows, and fewer slices are cut again.
GRID = 16
# Hash cells in which keys are counted before any of them is counted on its own.
CELLS = 1 << 16
_WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")


def _position(df: DataFrame, name: str) -> Column:
    """The order column as a whole number that sorts the same way and keeps different values apart."""
    kind = df.schema[name].dataType
    if kind.simpleString() in _WHOLE_NUMBERS:
        return F.col(name).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    raise TypeError(f"order column {name} must be a whole number, date or timestamp, not {kind.simpleString()}")


def _slot(position: Column, low: Column, width: Column) -> Column:
    # Rounding cannot break the order: subtraction, division and floor never decrease. Nulls sort first, and what is
    # too far from the lower end for a whole number goes last.
    slot = F.coalesce(F.floor(F.try_subtract(position, low) / width), F.lit(2**62))
    return F.when(position.isNull(), F.lit(-1).cast("bigint")).otherwise(slot)


def _bigint_table(df: DataFrame, rows: list[tuple], names: Sequence[str]) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, ", ".join(f"{n} bigint" for n in names))


@dataclass
class Cuts:
    """How to slice: one entry per level, each a list of (slice so far..., order column, low, width)."""

    order: list[str]
    slices: int
    levels: list[list[tuple]] = field(default_factory=list)

    def columns(self) -> list[str]:
        return [f"__slice{i}" for i in range(max(1, len(self.levels)))]

    def add_level(self, df: DataFrame, level: int) -> DataFrame:
        positions = [_position(df, name) for name in self.order]
        cuts, name = self.levels[level], f"__slice{level}"
        if level == 0:
            i, low, width = cuts[0]
            return df.withColumn(name, _slot(positions[i], F.lit(low).cast("bigint"), F.lit(width).cast("bigint")))
        prefix = [f"__cut{k}" for k in range(level)]
        table = _bigint_table(df, cuts, [*prefix, "__column", "__low", "__width"])
        match = [F.col(f"__slice{k}") == F.col(p) for k, p in enumerate(prefix)]
        position = F.coalesce(*[F.when(F.col("__column") == i, positions[i]) for i in sorted({c[level] for c in cuts})])
        slot = F.when(F.col("__low").isNotNull(), _slot(position, F.col("__low"), F.col("__width")))
        return (
            # One row per heavy slice, and there are at most a quarter as many as slices were asked for.
            df.join(F.broadcast(table), match, "left")
            .withColumn(name, F.coalesce(slot, F.lit(0).cast("bigint")))
            .drop(*prefix, "__column", "__low", "__width")
        )

    def apply(self, df: DataFrame) -> DataFrame:
        if not self.levels:
            return df.withColumn("__slice0", F.lit(0).cast("bigint"))
        for level in range(len(self.levels)):
            df = self.add_level(df, level)
        return df


def _finer_column(row: Row, count: int) -> int | None:
    """First order column that still varies inside the slice; None when only exact ties are left."""
    for i in range(count):
        constant = row[f"c{i}"] == 0 or (row[f"lo{i}"] == row[f"hi{i}"] and row[f"c{i}"] == row["n"])
        if not constant:
            return i
    return None


def plan_cuts(df: DataFrame, order: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE) -> Cuts:
    """Find slices of at most four times ``rows_per_slice`` rows. Reads the order columns only.

    Heavy slices are those above that, so at most a quarter as many of them as slices were asked for reach the driver per
    level. Each level narrows the range it cuts, so the loop ends.
    """
    df = df.select(*order)
    stats = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(order):
        p = _position(df, name)
        stats += [F.min(p).alias(f"lo{i}"), F.max(p).alias(f"hi{i}"), F.count(p).alias(f"c{i}")]
    whole = df.agg(*stats).first()
    slices = max(1, -(-whole["n"] // rows_per_slice))
    limit, cells = 4 * rows_per_slice, GRID * slices
    cuts, heavy = Cuts(list(order), slices), [whole] if whole["n"] else []
    while True:
        level, found = len(cuts.levels), []
        done = cuts.columns()[:level]
        for row in heavy:
            i = _finer_column(row, len(order))
            if i is not None:
                parts = max(16, cells // len(heavy))
                width = -(-(row[f"hi{i}"] - row[f"lo{i}"] + 1) // parts)
                found.append((*[row[c] for c in done], i, row[f"lo{i}"], width))
        if not found:
            return cuts
        cuts.levels.append(found)
        if whole["n"] <= limit:
            return cuts
        df = cuts.add_level(df, level)
        if level:
            kept = _bigint_table(df, [c[:level] for c in found], done)
            df = df.join(F.broadcast(kept), done, "left_semi")
        heavy = df.groupBy(*cuts.columns()).agg(*stats).where(F.col("n") > limit).collect()


def slice_rows(df: DataFrame, order: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE) -> tuple[DataFrame, list[str]]:
    """Add slice columns; sorted, they give the same order as the order columns."""
    cuts = plan_cuts(df, order, rows_per_slice)
    return cuts.apply(df), cuts.columns()


def hot_keys(df: DataFrame, key: Sequence[str], more_than: int, cells: int = CELLS) -> DataFrame | None:
    """The keys with more than ``more_than`` rows, exactly; None where there are none.

    Keys are first counted by ``cells`` hash cells, which moves at most that many numbers a task however many keys there
    are. A hot key's cell has at least its rows, so only keys of cells above the limit are counted one by one.
    """
    cell = F.pmod(F.xxhash64(*key), F.lit(cells))
    full = df.groupBy(cell.alias("__cell")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > more_than).select("__cell").collect()
    if not full:
        return None
    table = _bigint_table(df, [tuple(r) for r in full], ["__cell"])  # at most ``cells`` rows
    doubtful = df.select(*key, cell.alias("__cell")).join(F.broadcast(table), "__cell", "left_semi")
    hot = doubtful.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > more_than).select(*key)
    path = fresh_path(df.sparkSession, "hot-keys")
    hot.write.parquet(path)
    hot = df.sparkSession.read.schema(hot.schema).parquet(path)
    return None if hot.isEmpty() else hot


def slice_hot_keys(
    df: DataFrame, key: Sequence[str], order: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE,
) -> tuple[DataFrame, list[str]]:
    """Slice only keys with more than ``rows_per_slice`` rows; all other keys stay whole, in slice 0.

    There are at most as many such keys as slices in the whole table, which bounds the broadcast. Where there are none, a
    plain window per key is all that is left to do.
    """
    names = [f"__hot{i}" for i in range(len(key))]
    hot = hot_keys(df, key, rows_per_slice)
    if hot is None:
        return df.withColumn("__slice0", F.lit(0).cast("bigint")), ["__slice0"]
    hot = hot.select(*[F.col(k).alias(n) for k, n in zip(key, names, strict=True)], F.lit(True).alias("__hot"))
    match = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(key, names, strict=True)]
    marked = df.join(F.broadcast(hot), match, "left").drop(*names)
    cuts = plan_cuts(marked.where(F.col("__hot")).select(*order), order, rows_per_slice)
    sliced = cuts.apply(marked)
    for level, name in enumerate(cuts.columns()):
        # The first level starts at 1 for hot keys: 0 marks the rows that need no offset.
        value = F.col(name) + (2 if level == 0 else 0)
        sliced = sliced.withColumn(name, F.when(F.col("__hot"), value).otherwise(F.lit(0).cast("bigint")))
    return sliced.drop("__hot"), cuts.columns()


def running_sums(
    df: DataFrame,
    sums: Mapping[str, Column],
    order: Sequence[str],
    key: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
    slice_columns: Sequence[str] | None = None,
    carry: Mapping[str, int] | DataFrame | None = None,
) -> DataFrame:
    """Add, per row, the sum of each expression over all rows up to and including it.

    Finding the slices runs a few narrow aggregates when this is called, before any result is asked for.
    ``order`` has to tell any two rows (of one key) apart. ``slice_columns`` names columns that already cut the
    order into pieces of bounded size, otherwise they are found here. ``carry`` is what the sums start from:
    numbers, or with a key a frame with one row per key.
    """
    key, order, start = list(key), list(order), {}
    if isinstance(carry, DataFrame):
        return _with_carried_rows(df, sums, order, key, rows_per_slice, carry)
    start = carry or {}
    if slice_columns is None:
        df, cut = slice_hot_keys(df, key, order, rows_per_slice) if key else slice_rows(df, order, rows_per_slice)
        rows = df.where(F.col(cut[0]) > 0) if key else df
    else:
        cut, rows = list(slice_columns), df
    return _sum_up(df, rows, sums, order, key, cut, start)


def _sum_up(
    df: DataFrame, sliced: DataFrame, sums: Mapping[str, Column], order: list[str], key: list[str], cut: list[str],
    start: Mapping[str, int],
) -> DataFrame:
    """Running sums inside each slice plus the totals of the slices before it.

    ``sliced`` are the rows whose slices need an offset, one row per slice. With a key, which may be null, offsets enter as
    a row in front of their slice. Without, Spark decides how to join them: the rows are already dealt out by slice for
    the window, so a shuffled join moves only the offsets.
    """
    shared = [*key, *cut]
    totals = sliced.groupBy(*shared).agg(*[F.sum(e).cast("bigint").alias(n) for n, e in sums.items()])
    earlier = Window.partitionBy(*key).orderBy(*cut).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"__at{i}") for i, c in enumerate(shared)],
        *[F.sum(n).over(earlier).alias(f"__before_{n}") for n in sums],
    )
    if key:
        return _with_offset_rows(df, offsets, sums, order, shared, cut, start)
    inside = Window.partitionBy(*cut).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumns({f"__in_{n}": F.sum(e).over(inside) for n, e in sums.items()})
    match = [F.col(c) == F.col(f"__at{i}") for i, c in enumerate(cut)]
    out = local.join(offsets, match, "left").withColumns({
        n: (F.col(f"__in_{n}") + F.coalesce(F.col(f"__before_{n}"), F.lit(0)) + F.lit(start.get(n, 0))).cast("bigint")
        for n in sums
    })
    return out.drop(*[f"__in_{n}" for n in sums], *[f"__before_{n}" for n in sums], *[f"__at{i}" for i in range(len(cut))], *cut)


def _with_offset_rows(
    df: DataFrame, offsets: DataFrame, sums: Mapping[str, Column], order: list[str], shared: list[str], cut: list[str],
    start: Mapping[str, int],
) -> DataFrame:
    """Rows and offsets go through one shuffle and one sort; a join on a key that may be null would need them anew."""
    rows = df.withColumns({f"__add_{n}": e.cast("bigint") for n, e in sums.items()}).withColumn("__first", F.lit(1))
    extra = offsets.select(*[F.col(f"__at{i}").alias(c) for i, c in enumerate(shared)],
                           *[F.coalesce(f"__before_{n}", F.lit(0)).cast("bigint").alias(f"__add_{n}") for n in sums], F.lit(0).alias("__first"))
    inside = Window.partitionBy(*shared).orderBy("__first", *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.unionByName(extra, allowMissingColumns=True)
    out = both.withColumns({n: (F.sum(f"__add_{n}").over(inside) + F.lit(start.get(n, 0))).cast("bigint") for n in sums})
    return out.where(F.col("__first") == 1).drop("__first", *[f"__add_{n}" for n in sums], *cut)


def _with_carried_rows(
    df: DataFrame, sums: Mapping[str, Column], order: list[str], key: list[str], rows_per_slice: int, carry: DataFrame,
) -> DataFrame:
    """Carried sums enter as one extra row per key in front of its rows: no join on a key that may be hot.

    The extra rows have null order columns, so they fall into the first slice.
    """
    values = {n: F.col(f"__value_{n}") for n in sums}
    rows = df.withColumns({f"__value_{n}": e.cast("bigint") for n, e in sums.items()}).withColumn("__row", F.lit(1))
    extra = carry.select(*key, *[F.col(n).cast("bigint").alias(f"__value_{n}") for n in sums], F.lit(0).alias("__row"))
    both, cut = slice_hot_keys(rows.unionByName(extra, allowMissingColumns=True), key, order, rows_per_slice)
    out = _sum_up(both, both.where(F.col(cut[0]) > 0), values, ["__row", *order], key, cut, {})
    return out.where(F.col("__row") == 1).drop("__row", *[f"__value_{n}" for n in sums])
