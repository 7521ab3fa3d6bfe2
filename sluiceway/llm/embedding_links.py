"""Near-duplicate vectors: a forest of random-projection trees with overlapping splits, exact comparison in the leaves."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import bounded, cut
from sluiceway.llm.components import connected_components


@dataclass(frozen=True)
class Forest:
    """``overlap`` is the half width of the strip at a split that goes to both sides, in standard deviations of the
    distance that the projections of two vectors at the threshold have. A node splits while it has more than ``leaf``
    classes, up to ``depth`` times. ``block`` bounds the vectors that one comparison holds on either side."""

    trees: int = 4
    leaf: int = 800
    depth: int = 28
    overlap: float = 0.75
    block: int = 1024
    seed: int = 11


def _directions(dim: int, count: int, seed: int) -> np.ndarray:
    """``count`` random unit vectors, the same in every task."""
    found = np.random.default_rng((seed, dim)).standard_normal((dim, count))
    return found / np.linalg.norm(found, axis=0)


def _usable() -> Column:
    """Whether a row takes part. Nothing in it is null, so that its opposite is all other rows."""
    value = F.col("embedding")
    fine = F.forall(value, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False))
            & F.coalesce(F.exists(value, lambda x: x != 0), F.lit(False)))


def _unit(column: pd.Series) -> np.ndarray:
    x = np.array(column.tolist(), dtype="float64")
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _project(classes: DataFrame, forest: Forest) -> DataFrame:
    """Adds ``places``: for each tree its ``depth`` projections. All nodes of a level share a direction, so that one
    product serves the whole forest, and the trees are then grown on numbers alone."""

    @F.pandas_udf("array<float>")
    def places(values: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(values), dtype="object")
        for dim, rows in values.groupby(values.map(len)).groups.items():
            found = _unit(values.loc[rows]) @ _directions(dim, forest.trees * forest.depth, forest.seed)
            for k, row in zip(rows, found.astype("float32")):
                out.loc[k] = row
        return out

    return classes.withColumn("places", places("embedding"))


def grow(classes: DataFrame, threshold: float, forest: Forest) -> DataFrame:
    """(cls, leaf) for all leaves of a class in all trees, from ``classes`` (cls, label, embedding).

    Level by level: each node's median is found by an aggregate over all its rows, and rows go to the side of it where
    they are, or to both within the overlap. A node whose middle half is hardly wider than the overlap is not split: its
    vectors are so near each other that a split would only copy them.
    """
    placed = cut(_project(classes, forest).select("cls", "label", F.size("embedding").alias("dim"), "places"), "forest-places")
    trees = F.array(*(F.lit(t) for t in range(forest.trees)))
    node = ["label", "dim", "tree", "node"]
    open_rows = placed.select("cls", "label", "dim", "places", F.explode(trees).alias("tree"), F.lit(1).cast("long").alias("node"))
    sigma = F.lit(float(np.sqrt(2 * (1 - threshold)))) / F.sqrt("dim")
    done = None
    for level in range(forest.depth + 1):
        place = F.element_at("places", F.col("tree") * forest.depth + F.lit(min(level, forest.depth - 1) + 1))
        here = cut(open_rows.withColumn("place", place), "forest-level")
        stats = here.groupBy(*node).agg(F.count(F.lit(1)).alias("rows"),
                                        F.percentile_approx("place", [0.25, 0.5, 0.75], 1000).alias("quarters"))
        quarters = F.col("quarters")
        wide = quarters[2] - quarters[0] > 4 * forest.overlap * sigma
        splits = cut(stats.withColumn("split", (F.col("rows") > forest.leaf) & wide & F.lit(level < forest.depth)).select(
            F.struct(*node).alias("of"), "split", quarters[1].alias("middle")), "forest-splits")
        joined = here.join(bounded(splits), F.struct(*node) == F.col("of"))
        leaves = joined.filter("NOT split").select("cls", F.xxhash64(*node).alias("leaf"))
        done = leaves if done is None else done.unionByName(leaves)
        if splits.filter("split").isEmpty():
            break
        margin = forest.overlap * sigma
        sides = F.array_compact(F.array(F.when(F.col("place") < F.col("middle") + margin, F.col("node") * 2),
                                        F.when(F.col("place") >= F.col("middle") - margin, F.col("node") * 2 + 1)))
        open_rows = joined.filter("split").select("cls", "label", "dim", "places", "tree", F.explode(sides).alias("node"))
    return done


def _compare(threshold: float):
    """Compare the vectors of two blocks of a leaf. Each pair counts in the smallest leaf that both have, and only there."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        unit, ids, counts = _unit(group["embedding"]), group["cls"].to_numpy(), group["members"].to_numpy()
        first, second = (np.flatnonzero(group["side"].to_numpy() & bit) for bit in (1, 2))
        leaf = int(group["leaf"].iloc[0])
        lists = group["leaves"].tolist()
        leaves = np.full((len(lists), max(map(len, lists))), leaf, dtype="int64")
        for k, found in enumerate(lists):
            leaves[k, :len(found)] = found
        links, parent = np.zeros(len(ids), dtype="int64"), np.arange(len(ids))
        rows, columns = np.nonzero(unit[first] @ unit[second].T >= threshold)
        a, b = first[rows], second[columns]
        # In a block against itself each pair once; between two blocks no vector stands on both sides.
        keep = a < b if len(first) == len(ids) else np.ones(len(a), dtype=bool)
        a, b = a[keep], b[keep]
        for at in range(0, len(a), 50_000):
            x, y = a[at:at + 50_000], b[at:at + 50_000]
            same = leaves[x][:, :, None] == leaves[y][:, None, :]
            least = np.where(same.any(axis=2), leaves[x], np.iinfo("int64").max).min(axis=1)
            x, y = x[least == leaf], y[least == leaf]
            np.add.at(links, x, counts[y])
            np.add.at(links, y, counts[x])
        # Smallest class of each group of linked vectors: pass the smaller one on until nothing changes.
        low = ids.copy()
        while len(a):
            was = low.copy()
            np.minimum.at(low, a, low[b])
            np.minimum.at(low, b, low[a])
            if (was == low).all():
                break
        touched = (links > 0) | (low < ids)
        return pd.DataFrame({"cls": ids[touched], "links": links[touched], "low": low[touched]})

    return run


def embedding_links(vectors: DataFrame, threshold: float = 0.98, forest: Forest = Forest()) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors with equal labels link where their cosine, in double precision, is at least ``threshold``. Pairs are looked
    for in the leaves of the forest; each pair found is computed exactly, so there are no false links, and a link is
    missed only if every tree parts the two by more than the overlap.

    Equal vectors of a label are one class, compared once and counted as often as they occur; a large group of near
    vectors is compared in blocks, several tasks to a leaf. Null labels, null, empty and zero vectors, vectors with null or
    non-finite parts, and rows without vec_id link with nothing; a row without vec_id has no component and is kept.
    Vectors of different lengths are never compared. Equal rows link with each other; rows with one vec_id and different
    vectors or labels are different vectors, each with its own links. Other columns are ignored.
    """
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    usable = rows.filter(_usable())
    # Named by a number of their own: one vec_id may stand for several vectors. The table is written, so the numbers stay.
    grouped = usable.groupBy("label", "embedding").agg(F.min("vec_id").cast("long").alias("first_id"), F.count(F.lit(1)).alias("members"))
    classes = cut(grouped.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    leaf_rows = cut(grow(classes, threshold, forest).distinct(), "forest-leaves")
    per_class = leaf_rows.groupBy("cls").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
    blocks = leaf_rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / forest.block).cast("int").alias("blocks"))
    # Block k of a leaf meets every block: as the first side of (k, j), as the second of (i, k), as both of (k, k).
    mine = F.pmod(F.xxhash64("cls", "leaf"), F.col("blocks")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least(j, F.col("mine")).alias("i"), F.greatest(j, F.col("mine")).alias("j"),
        F.when(j == F.col("mine"), 3).when(F.col("mine") < j, 1).otherwise(2).alias("side")))
    dealt = leaf_rows.join(blocks, "leaf").withColumn("mine", mine).withColumn("meet", F.explode(meets)).select(
        "leaf", "cls", "meet.i", "meet.j", "meet.side")
    pairs = dealt.join(classes.drop("first_id").join(per_class, "cls"), "cls")
    found = cut(pairs.groupBy("label", "leaf", "i", "j").applyInPandas(_compare(threshold), "cls long, links long, low long"), "vector-links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    component = connected_components(found.select(F.col("cls").alias("a"), F.col("low").alias("b")), "vector-components")
    in_component = cut(component.withColumnRenamed("node", "cls").join(classes.select("cls", "first_id"), "cls"), "vector-components")
    named = in_component.groupBy("component").agg(F.min("first_id").alias("least_id"))
    least = in_component.select("cls", "component").join(named, "component").select("cls", "least_id")
    known = classes.join(links, "cls", "left").join(least, "cls", "left").select(
        F.struct("label", "embedding").alias("is"), (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"),
        F.coalesce("least_id", "first_id").alias("component_id"))
    linked = usable.select("vec_id", "label", "embedding").join(known, F.struct("label", "embedding") == F.col("is")).select(
        "vec_id", "n_links", "component_id")
    alone = rows.filter(~_usable())
    return linked.unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
                              ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
