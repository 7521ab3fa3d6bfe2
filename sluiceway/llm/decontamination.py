"""Benchmark decontamination: a hash set of test n-grams against every window of the training texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import WORD, ascii_lower, bounded, cut, packed, text_key

N_WORDS = 10
#: The same words before they are lower-cased.
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words; of null, none."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _window_hash(codes: Column, at: Column, n: int) -> Column:
    return F.xxhash64(F.lit(n), *(F.get(codes, at + k) for k in range(n)))


def _window_hashes(codes: Column, size: Column, n: int) -> Column:
    at = F.sequence(F.lit(0), size - n)
    return F.when(size >= n, F.transform(at, lambda i: _window_hash(codes, i, n))).otherwise(F.array().cast("array<bigint>"))


def _word_codes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def benchmark_grams(benchmark: DataFrame, n: int = N_WORDS) -> DataFrame:
    """The test set's windows: ``gram`` (its words), ``hash``, ``n`` and the ``items`` it stands in.

    Items of fewer than ``n`` words, but not none, are one window. Null and empty texts have none.
    """
    words = benchmark.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    windows = F.when(F.size("words") >= n, F.transform(
        F.sequence(F.lit(1), F.size("words") - (n - 1)), lambda i: F.slice("words", i, n))).otherwise(F.array("words"))
    grams = words.select("item_id", F.explode_outer(windows).alias("gram")).groupBy("gram").agg(F.collect_set("item_id").alias("items"))
    sized = grams.withColumn("n", F.size("gram"))
    code = None
    for k in range(1, n + 1):
        of_k = _window_hash(_word_codes(F.col("gram")), F.lit(0), k)
        code = F.when(F.col("n") == k, of_k) if code is None else code.when(F.col("n") == k, of_k)
    return sized.withColumn("hash", code)


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_id, n_words, ``spans`` (pos, n) that stand in the benchmark, ``items``.

    Every window of a document is hashed and probes the hash set; only where a hash is found are the words themselves
    compared, so a hit is a hit. The set is broadcast while it is small (its rows are counted), and a shuffled join
    beyond. A document's words never leave its task; what is shuffled is a row per document and per hit.

    Equal rows have equal results, each its own row. Null or empty text: no words, no hits. Null item_id: its windows
    hit, but it is not counted among the items. Empty tables: no rows, or no hits. Other columns are ignored.
    """
    grams = cut(benchmark_grams(benchmark, n), "benchmark-grams").select(
        F.col("hash").alias("g_hash"), F.col("gram"), F.col("n").alias("g_n"), "items")
    lengths = sorted((r.g_n for r in grams.select("g_n").distinct().collect()), reverse=True)  # at most n numbers
    words = docs.select("doc_id", text_key(F.col("text")).alias("text_id"), words_of(F.col("text")).alias("words"))
    coded = words.withColumn("codes", _word_codes(F.col("words")))
    size = F.size("words")
    # All windows of one length after the other, and at the end one entry that stands for the document itself. (An inner
    # explode would make Spark test the list's size in a filter at the scan, and so work the whole list out twice.)
    parts, starts, begin = [], [], F.lit(0)
    for k in lengths:
        parts.append(_window_hashes(F.col("codes"), size, k))
        starts.append((k, begin))
        begin = begin + F.greatest(size - (k - 1), F.lit(0))
    listed = coded.withColumn("hashes", F.concat(*parts, F.array(F.lit(None).cast("bigint"))))
    probes = listed.select("doc_id", "text_id", "words", size.alias("n_words"), F.posexplode_outer("hashes").alias("entry", "hash"))
    itself = F.col("hash").isNull()
    n_here, pos = F.lit(0), F.lit(0)
    for k, start in starts:
        n_here = F.when(F.col("entry") >= start, F.lit(k)).otherwise(n_here)
        pos = F.when(F.col("entry") >= start, F.col("entry") - start).otherwise(pos)
    hits = probes.withColumns({"n": n_here, "pos": pos}).join(bounded(grams), F.col("hash") == F.col("g_hash"), "left").filter(
        itself | ((F.col("n") == F.col("g_n")) & (F.slice("words", F.col("pos") + 1, F.col("n")) == F.col("gram"))))
    found = hits.groupBy("doc_id", "text_id", "n_words").agg(
        F.count_if(itself).alias("copies"),
        F.array_sort(F.collect_set(F.when(~itself, F.struct("pos", "n")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copy", "copies")


def words_hit(spans: Column) -> Column:
    """How many words stand inside at least one of the sorted spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit"))
    return F.aggregate(spans, start, lambda a, s: F.struct(
        F.greatest(a["end"], s["pos"] + s["n"]).alias("end"),
        (a["hit"] + F.greatest(F.lit(0), s["pos"] + s["n"] - F.greatest(a["end"], s["pos"]))).alias("hit")))["hit"].cast("long")


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = N_WORDS, remove: str = "documents") -> DataFrame:
    """``docs`` without what stands in the benchmark, all columns kept.

    ``documents`` removes each document with a hit. ``spans`` removes the words of the hits, and all that is not a word
    between two of them; where n_chars is a column, it follows.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is documents or spans")
    bad = contamination(docs, benchmark, n).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "text_id"]).select(
        F.struct("doc_id", "text_id", "spans").alias("found"))
    rows, text = packed(docs), F.col("row.text")
    here = F.col("row.doc_id").eqNullSafe(F.col("found.doc_id")) & (text_key(text) == F.col("found.text_id"))
    if remove == "documents":
        return rows.join(bad, here, "left_anti").select("row.*")
    # Words and what stands between them take turns: gap 0, word 0, gap 1, word 1, ... The gap after a kept word stays.
    # Through a one-element list, so that Spark splits the text once and not at each use.
    parts = F.struct(F.regexp_extract_all(text, F.lit(CASED_WORD), F.lit(0)).alias("words"), F.split(text, CASED_WORD).alias("gaps"))

    def without(part: Column) -> Column:
        hit = F.flatten(F.transform("found.spans", lambda s: F.sequence(s["pos"], s["pos"] + s["n"] - 1)))
        left = F.array_except(F.sequence(F.lit(0), F.size(part["words"]) - 1), hit)
        return F.concat(part["gaps"][0], F.array_join(F.transform(left, lambda i: F.concat(
            F.get(part["words"], i), F.get(part["gaps"], i + 1))), ""))

    kept = F.get(F.transform(F.array(parts), without), 0)
    hit = F.col("found").isNotNull()
    out = {c: F.col("row")[c] for c in docs.columns} | {"text": F.when(hit, kept).otherwise(text)}
    if "n_chars" in out:
        out["n_chars"] = F.when(hit, F.length(kept).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return rows.join(bad, here, "left").select(*(column.alias(name) for name, column in out.items()))
