"""Sharding along a Hilbert curve: rows that are near in several metadata dimensions end in the same file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.llm.common import bounded, cut, fold_rows, hash_fraction, packed, place_rows, prefix_sums, text_key, unfold_rows


def hilbert_steps(axes: Sequence[str], bits: int, to: str) -> list[dict[str, str]]:
    """SQL that turns whole numbers of ``bits`` bits in ``axes`` into the position ``to`` on their Hilbert curve.

    Each step is a projection: new expressions for some columns. The method undoes the curve's turns bit by bit from the
    highest, then reads the Gray code off (J. Skilling, 2004). ``a ^ b`` is written ``(a | b) - (a & b)``, which all SQL
    engines have.
    """
    xor = lambda a, b: f"(({a} | {b}) - ({a} & {b}))"
    first, steps = axes[0], []
    for bit in range(bits - 1, 0, -1):
        q, p = 1 << bit, (1 << bit) - 1
        for x in axes:
            turn = f"({xor(first, x)} & {p})"
            if x == first:
                steps.append({x: f"CASE WHEN ({x} & {q}) <> 0 THEN {xor(x, p)} ELSE {x} END"})
            else:
                steps.append({first: f"CASE WHEN ({x} & {q}) <> 0 THEN {xor(first, p)} ELSE {xor(first, turn)} END",
                              x: f"CASE WHEN ({x} & {q}) <> 0 THEN {x} ELSE {xor(x, turn)} END"})
    for before, x in zip(axes, axes[1:]):
        steps.append({x: xor(x, before)})
    # Bit b of the turn is the parity of the last axis' bits above b.
    ones = [f"CASE WHEN ({axes[-1]} & {1 << b}) <> 0 THEN 1 ELSE 0 END" for b in range(bits)]
    steps.append({"turn": " + ".join(["0"] + [f"(({' + '.join(ones[b + 1:])}) % 2) * {1 << b}" for b in range(bits - 1)])})
    steps.append({x: xor(x, "turn") for x in axes})
    place = [f"CASE WHEN ({x} & {1 << b}) <> 0 THEN {1 << (b * len(axes) + len(axes) - 1 - i)} ELSE 0 END"
             for b in range(bits) for i, x in enumerate(axes)]
    steps.append({to: f"CAST({' + '.join(place)} AS BIGINT)"})
    return steps


def apply_steps(df: DataFrame, steps: list[dict[str, str]]) -> DataFrame:
    for step in steps:
        df = df.withColumns({name: F.expr(sql) for name, sql in step.items()})
    return df


def _number(column: Column, kind: T.DataType, prefix: Column) -> Column:
    """A number that keeps the order of the values: texts by the four characters after what all of them begin with."""
    if isinstance(kind, T.StringType):
        rest = F.substr(column, F.length(prefix) + 1, F.lit(4))
        codes = [F.ascii(F.substr(rest, F.lit(i + 1), F.lit(1))) for i in range(4)]
        return sum((F.least(c, F.lit(1023)) * float(1024 ** (3 - i)) for i, c in enumerate(codes)), F.lit(0.0))
    value = column.cast("double")
    return F.when(F.isnan(value), None).otherwise(F.signum(value) * F.log1p(F.abs(value)))


def _shared_prefix(low: Column, high: Column) -> Column:
    """What the smallest and the largest text begin with, and so all between them."""
    same = F.filter(F.sequence(F.lit(1), F.lit(64)), lambda i: F.left(low, i) == F.left(high, i))
    at_most = F.least(F.length(low), F.length(high))
    return F.left(low, F.least(F.coalesce(F.array_max(same), F.lit(0)), at_most))


def grid_cells(df: DataFrame, dimensions: Sequence[str], bits: int) -> DataFrame:
    """Adds ``axis0``.. : each dimension quantised to ``2 ** bits`` levels, level 0 for null.

    Levels are even steps between the smallest and the largest value: of numbers on a logarithmic scale, of texts by
    the characters after their shared beginning. Two rounds of minimum and maximum are all that is gathered.
    """
    kinds = {d: df.schema[d].dataType for d in dimensions}
    texts = [d for d in dimensions if isinstance(kinds[d], T.StringType)]
    edges = df.agg(*(f(d).alias(f"{n}{i}") for i, d in enumerate(texts) for n, f in (("low", F.min), ("high", F.max))),
                   F.count(F.lit(1)).alias("all"))
    prefixes = edges.select(*(F.coalesce(_shared_prefix(F.col(f"low{i}"), F.col(f"high{i}")), F.lit("")).alias(f"p{i}")
                              for i in range(len(texts)))).first() if texts else ()
    number = {d: _number(F.col(d), kinds[d], F.lit(prefixes[texts.index(d)] if d in texts else "")) for d in dimensions}
    ends = df.agg(*(f(number[d]).alias(f"{n}{i}") for i, d in enumerate(dimensions) for n, f in (("a", F.min), ("b", F.max)))).first()
    top = (1 << bits) - 2

    def level(i: int, d: str) -> Column:
        low, high = ends[f"a{i}"], ends[f"b{i}"]
        wide = (high - low) if low is not None and high > low else 1.0
        step = F.floor((number[d] - F.lit(low)) / F.lit(float(wide)) * float(top)).cast("int") + 1
        return F.coalesce(step, F.lit(0))

    return df.withColumns({f"axis{i}": level(i, d) for i, d in enumerate(dimensions)})


def hilbert_shards(docs: DataFrame, dimensions: Sequence[str] = ("source", "lang", "size"), shards: int = 16,
                   bits: int = 5) -> DataFrame:
    """One row per row of ``docs`` with its shard and slot, as ``_dealt`` says."""
    return _dealt(docs, dimensions, shards, bits).drop("copy", "copies")


def _dealt(docs: DataFrame, dimensions: Sequence[str] = ("source", "lang", "size"), shards: int = 16, bits: int = 5) -> DataFrame:
    """One row per row of ``docs`` with its shard and slot; other columns than doc_id, text and dimensions are ignored.

    Dimensions are quantised, the cells ordered along a Hilbert curve, and the curve is cut into ``shards`` runs of
    counts at most one apart. ``slot`` counts from 0 in each shard, along the curve. ``size``, the bytes of the text plus
    1, may be a dimension (a column of that name in ``docs`` is not read).

    The order is total and fixed by hashes: by cell, then by a hash of doc_id and text; reruns agree. A hot cell is
    cut into as many slices as the root of its rows, so no task sorts more rows than that. Equal rows are folded to one
    with a count before and unfolded after, with neighbouring slots. Null dimensions have a level of their own; null text
    counts 1 byte and has no checksum; an empty table gives no rows.
    """
    text = F.col("text")
    sized = docs.withColumns({
        "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1,
        "text_id": text_key(text), "text_crc32": F.when(text.isNotNull(), F.crc32(text)),
    })
    keys = ["doc_id", "size", "text_id", "text_crc32", *(d for d in dimensions if d not in ("doc_id", "size"))]
    folded = cut(fold_rows(sized.select(*keys), keys), "shard-documents")
    axes = [f"axis{i}" for i in range(len(dimensions))]
    placed = grid_cells(folded, dimensions, bits)
    # One row per cell in use, at most 2 ** (bits * dimensions): the curve is worked out for cells, not for rows.
    # They are written first: axes of one value only are constants, which the optimizer would fold through all the steps.
    used = cut(placed.groupBy(*axes).agg(F.sum("copies").alias("cell_rows")), "shard-cells")
    cells = apply_steps(used.withColumns({f"at_{a}": F.col(a) for a in axes}), hilbert_steps(axes, bits, "curve"))
    so_far = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(cells.select(*(f"at_{a}" for a in axes), "curve", F.ceil(F.sqrt("cell_rows")).alias("slices"),
                              F.coalesce(F.sum("cell_rows").over(so_far), F.lit(0)).alias("cell_start"),
                              F.sum("cell_rows").over(Window.partitionBy()).alias("total")), "shard-cells")
    at = F.lit(True)
    for a in axes:
        at = at & (F.col(a) == F.col(f"at_{a}"))
    keyed = placed.join(bounded(starts), at).drop(*axes, *(f"at_{a}" for a in axes)).withColumns({
        "key": hash_fraction(F.col("doc_id"), F.col("text_id")), "weight": F.col("copies")})
    ranked = unfold_rows(prefix_sums(keyed, ["curve"], "key", keys, "weight", "slices"))
    rank = ranked.withColumn("rank", F.col("cell_start") + F.col("before") + F.col("copy"))
    shard = rank.withColumn("shard", F.expr(f"CAST(rank * {shards} DIV total AS INT)"))
    first = F.expr(f"(CAST(shard AS BIGINT) * total + {shards - 1}) DIV {shards}")
    return shard.select("doc_id", "size", "text_id", "text_crc32", *(d for d in dimensions if d not in ("doc_id", "size")), F.lit("rows").alias("law"), "shard",
                        (F.col("rank") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "copy", "copies")


def shard_rows(docs: DataFrame, dimensions: Sequence[str] = ("source", "lang", "size"), **settings) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (columns of these names are replaced), as ``hilbert_shards`` deals them.

    Each row stays as it is. Rows that are equal in doc_id, text and dimensions are numbered by a hash of the whole row and get
    the plan's places in that order. Null doc_id, text and dimensions are values of their own; an empty table gives none.
    """
    own = [d for d in dimensions if d not in ("doc_id", "size")]
    keys = ["doc_id", "text_id", *own]
    plan = cut(_dealt(docs, dimensions, **settings).select(*keys, "copy", "copies", "shard", "slot"), "shard-plan")
    rows = packed(docs.drop("shard", "slot"))
    keyed = rows.select(*(F.col("row")[c].alias(c) for c in ("doc_id", *own)), text_key(F.col("row.text")).alias("text_id"), "row")
    return place_rows(keyed, keys, plan).select("row.*", "shard", "slot")


def write_shards(docs: DataFrame, path: str, **settings) -> None:
    """One folder per shard, its rows in curve order, so that readers can skip files and row groups by their statistics.

    Rows as in ``shard_rows``; an empty table gives an empty folder.
    """
    placed = shard_rows(docs, **settings)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
