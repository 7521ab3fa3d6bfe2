"""Substring dedup: lines or sentences that repeat across or inside documents stay where they come first."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import bounded, cut, drop_cut, hash_filter, may_hold, packed, text_key

#: Units follow each other without a gap, so that their lengths give their offsets. A sentence ends a unit, a line too.
UNITS = {"line": r"[^\n]*\n+|[^\n]+", "sentence": r"[^.!?\n]*[.!?\n]+[ \t]*|[^.!?\n]+"}


#: What separates words: ASCII punctuation becomes a space, then white space splits.
_SEPARATORS = {k: " " for k in range(128) if not chr(k).isalnum()}
_DIGESTED = "pos int, last int, d1 long, d2 long"
#: So many texts are digested before their digests are handed on.
_TEXTS = 200


def runs_of(text: str, unit: str, least_words: int) -> set[tuple[int, int, str]]:
    """(first unit, last unit, words) of all runs of units that are compared; words in lower case, by single spaces.

    A unit of at least ``least_words`` words stands alone. A shorter one is joined with what follows, and with what comes
    before, until the run has so many words: each repeated run of so many words is covered by these, down to the short
    units at its edges. Lines of any length are runs too. Units without a word do not count.
    """
    units, line, lines = [], 0, []
    for k, piece in enumerate(re.findall(UNITS[unit], text.lower())):
        words = piece.translate(_SEPARATORS).split()
        if words:
            units.append((k, words))
            lines.append(line)
        line += "\n" in piece
    found = set()

    def add(i: int, j: int) -> None:
        found.add((units[i][0], units[j][0], " ".join(w for _, words in units[i:j + 1] for w in words)))

    for i, (_, words) in enumerate(units):
        if len(words) >= least_words:
            add(i, i)
            continue
        for step in (1, -1):
            j, count = i, len(words)
            while count < least_words and 0 <= j + step < len(units):
                j += step
                count += len(units[j][1])
            if count >= least_words:
                add(min(i, j), max(i, j))
    start = 0
    for i in range(1, len(units) + 1):
        if i == len(units) or lines[i] != lines[start]:
            add(start, i - 1)
            start = i
    return found


def _digests(docs: DataFrame, unit: str, least_words: int) -> DataFrame:
    """(doc_id, text_no, pos, last, d1, d2): a digest of 128 bits for each run of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(at, _TEXTS)
                row, pos, last, digests = array("q"), array("i"), array("i"), bytearray()
                for k, text in enumerate(part.column("text").to_pylist()):
                    for first, end, words in runs_of(text, unit, least_words):
                        row.append(k)
                        pos.append(first)
                        last.append(end)
                        digests += md5(words.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()
                d = np.frombuffer(bytes(digests), dtype="<i8").reshape(-1, 2)
                rows = pa.array(np.array(row, dtype="int64"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(rows), part.column("text_no").take(rows), pa.array(np.array(pos, dtype="int32")),
                     pa.array(np.array(last, dtype="int32")), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy())],
                    names=["doc_id", "text_no", "pos", "last", "d1", "d2"])

    texts = docs.filter("text <> ''").select("doc_id", F.xxhash64(text_key(F.col("text"))).alias("text_no"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, text_no long, {_DIGESTED}")


def _may_repeat(units: DataFrame, known: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(known.value, batch.column("d1").to_numpy())))

    return units.mapInArrow(run, units.schema)


def repeated_units(docs: DataFrame, unit: str = "sentence", least_words: int = 5, filter_bits: int = 28) -> DataFrame:
    """(doc_id, text_no, removed): the numbers of the units of each document that stood somewhere before.

    Digests of 128 bits of all runs (``runs_of``) are grouped over the whole table; the earliest occurrence is kept, by
    doc_id, then text, then place, and of a later one that overlaps it only what lies behind it goes. Equal rows (doc_id
    and text) count as one document. Null doc_id comes first.

    First only one half of each digest is counted. What occurs more than once makes a filter of ``2 ** filter_bits`` bits, and
    only units that pass it are moved with their places; what passes wrongly is compared like the rest, by the whole digest. Counts and
    minima are combined before the shuffle.
    """
    # Written once and read twice: working units out costs more than their digests take.
    units = cut(_digests(docs, unit, least_words), "dedup-units")
    twice = units.groupBy(F.col("d1").alias("h")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    known = hash_filter(twice, filter_bits)
    likely = cut(_may_repeat(units, known), "dedup-likely")
    known.unpersist()
    drop_cut(units)
    seen = likely.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "text_no", "pos", "last")).alias("first"), F.count(F.lit(1)).alias("n"))
    repeats = cut(seen.filter("n > 1").select(F.col("d1").alias("r1"), F.col("d2").alias("r2"), "first"), "dedup-repeats")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_no") == F.col("first.text_no"))
    # The first occurrence itself, which equal rows repeat, is left by this with nothing to remove.
    start = F.when(same, F.greatest("pos", F.col("first.last") + 1)).otherwise(F.col("pos"))
    later = likely.join(repeats, (F.col("d1") == F.col("r1")) & (F.col("d2") == F.col("r2"))).withColumn("start", start).filter("start <= last")
    gone = F.transform(F.collect_set(F.struct("start", "last")), lambda r: F.sequence(r["start"], r["last"]))
    found = cut(later.groupBy("doc_id", "text_no").agg(F.array_sort(F.array_distinct(F.flatten(gone))).alias("removed")), "dedup-removed")
    drop_cut(likely, repeats)
    return found


def cut_units(text: str, removed: list[int], unit: str, least_words: int) -> tuple[str, list[dict[str, int]]]:
    """A text without the removed units, and their offsets in characters of it as it was, neighbours joined.

    Units without a word go with the units next to them, where all of these go.
    """
    pieces, gone = re.findall(UNITS[unit], text), set(removed)
    worded = [k for k, piece in enumerate(pieces) if piece.translate(_SEPARATORS).split()]
    for a, b in zip([None, *worded], [*worded, None]):
        if gone.issuperset({a, b} - {None}):
            gone.update(range(0 if a is None else a + 1, len(pieces) if b is None else b))
    kept, spans, at = [], [], 0
    for k, piece in enumerate(pieces):
        end = at + len(piece)
        if k not in gone:
            kept.append(piece)
        elif spans and spans[-1]["end"] == at:
            spans[-1]["end"] = end
        else:
            spans.append({"start": at, "end": end})
        at = end
    return "".join(kept), spans


def dedup_substrings(docs: DataFrame, unit: str = "sentence", least_words: int = 5) -> DataFrame:
    """``docs`` with ``text`` cleaned of repeated units and ``removed``, the spans (start, end) that went, by the old text.

    Null, empty and unrepeated texts stay as they are, with no spans. Other columns stay (one named removed is
    replaced); where n_chars is one, it follows. Only texts with something to remove go to Python.
    """

    @F.pandas_udf("text string, removed array<struct<start:int,end:int>>")
    def clean(texts: pd.Series, removed: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cut_units(t, list(r), unit, least_words) for t, r in zip(texts, removed)], columns=["text", "removed"])

    found = repeated_units(docs, unit, least_words).select(F.struct("doc_id", "text_no", "removed").alias("found"))
    rows, text = packed(docs.drop("removed")), F.col("row.text")
    here = F.col("row.doc_id").eqNullSafe(F.col("found.doc_id")) & (F.xxhash64(text_key(text)) == F.col("found.text_no"))
    joined = rows.join(bounded(found), here, "left")
    cleaned = joined.filter("found IS NOT NULL").withColumn("new", clean.asNondeterministic()(text, F.col("found.removed")))
    same = joined.filter("found IS NULL").withColumn("new", F.struct(text.alias("text"), F.array().cast(
        "array<struct<start:int,end:int>>").alias("removed"))).select("row", "new")
    both = cleaned.select("row", "new").unionByName(same)
    out = {c: F.col("row")[c] for c in docs.columns if c != "removed"} | {"text": F.col("new.text")}
    if "n_chars" in out:
        out["n_chars"] = F.when(F.size("new.removed") > 0, F.length("new.text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return both.select(*(column.alias(name) for name, column in out.items()), F.col("new.removed").alias("removed"))
