"""Decontamination, mixing and sharding against plain Python over the same rows."""

import collections
import hashlib
import itertools
import math
import zlib

import pytest
from pyspark.sql import functions as F

from sluiceway.llm import decontamination, mixing, sharding
from sluiceway.llm.queries import LLM_QUERIES
from helpers import CLASHING, bench_words, frame, tokens

SF_DIR = "/root/testdata/sf0.001"


def brute_contamination(docs, items):
    grams = collections.defaultdict(set)
    for item, text in items:
        w = bench_words(text)
        for k in range(max(1, len(w) - 9)) if w else ():
            grams[tuple(w[k:k + 10])].add(item)
    out = []
    for doc, text in docs:
        w, hit, found = bench_words(text), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k:k + n])) in grams:
                    hit |= set(range(k, k + n))
                    found |= grams[g] - {None}
        ids = ",".join(sorted(map(str, found)))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def derived(found):
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    hit = decontamination.words_hit(F.col("spans"))
    return sorted((tuple(r) for r in found.select("doc_id", F.col("n_words").cast("long"), hit, F.size("items").cast("long"),
                                                  F.sha2(F.array_join(ids, ","), 256), hit > 0).collect()), key=str)


def test_decontamination_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted((tuple(r) for r in LLM_QUERIES["op1_decontamination"](spark, SF_DIR).collect()), key=str)
    assert got == brute_contamination(docs, items)
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def test_decontamination_edge_cases(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(1, f"Before {passage.upper()}, after. {passage}"), (1, f"Before {passage.upper()}, after. {passage}"), (2, None), (3, ""),
            (4, "tiny ITEM"), (5, "one two three four five six seven eight nine eleven"), (None, f"x {passage}"), (6, "ÉCOLE école " * 500),
            (7, "a b " * 20000 + passage)]
    items = [(10, passage), (9, "x y " + passage), (100, "Tiny item"), (11, None), (12, "..."), (None, "four five six seven eight nine ten eleven twelve x"),
             (13, "école"), (10, passage)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wide = frame(spark, docs, CLASHING)
    assert derived(decontamination.contamination(wide, bench)) == brute_contamination([d[:2] for d in docs], items)
    assert derived(decontamination.contamination(wide.limit(0), bench)) == []
    assert derived(decontamination.contamination(frame(spark, docs), bench.limit(0))) == brute_contamination([d[:2] for d in docs], [])
    kept = decontamination.decontaminate(wide, bench)
    assert kept.columns == wide.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
    spans = {r.doc_id: r for r in decontamination.decontaminate(frame(spark, docs), bench, remove="spans").collect()}
    assert spans[1].text == "Before after. " and spans[1].n_chars == 14 and spans[5].text == docs[5][1] and spans[2].text is None
    assert spans[7].text == "a b " * 20000


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, budget = {}, set(names), share * sum(sizes.values())
    while free:
        each = {s: budget * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if each[s] > most * sizes[s]}
        if not full:
            target |= each
            break
        for s in full:
            target[s] = most * sizes[s]
            budget -= target[s]
        free -= full
    return target


def check_mix(rows, sources):
    """rows: (doc_id, size, source_size, target, taken, source)."""
    sizes = collections.Counter()
    for r in rows:
        sizes[r[5]] += r[1]
    want = brute_targets(sizes)
    taken = collections.Counter()
    for _, size, source_size, target, took, source in rows:
        assert source_size == sizes[source] and target == pytest.approx(want[source])
        assert 0 <= took <= 2 * size
        taken[source] += took
    for s, t in want.items():
        assert taken[s] == (math.floor(t + 1e-9) if sizes[s] else 0)


def test_mixing_query(spark):
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    first = sorted(tuple(r) for r in LLM_QUERIES["op4_mixing"](spark, SF_DIR).collect())
    check_mix([(*r, source[r[0]]) for r in first], None)
    assert first == sorted(tuple(r) for r in LLM_QUERIES["op4_mixing"](spark, SF_DIR).collect())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert all(r[1] == len(tokens(texts[r[0]])) for r in first)


def test_mixing_edge_cases(spark):
    rows = ([(k, "w " * (k % 17), "en", "big") for k in range(300)] + [(7, "a b c", "en", "rep")] * 40 + [(None, "x y", "en", None)] * 5
            + [(900, None, None, "none"), (901, "", "en", "none"), (902, "é ü v\tw", "fr", "Z"), (903, "long " * 30000, "en", "Z")])
    wide = frame(spark, rows, CLASHING)
    plan = mixing.mix_plan(wide).collect()
    assert len(plan) == len(rows)
    check_mix([(r.doc_id, r["size"], r.source_size, r.target, r.taken, r.source) for r in plan], None)
    mixed = mixing.mix(wide)
    assert mixed.columns == wide.columns
    words = collections.Counter()
    for r in mixed.collect():
        words[r.source] += len(tokens(r.text))
    taken = collections.Counter()
    for r in plan:
        taken[r.source] += r.taken
    assert all(abs(words[s] - n) <= 40 for s, n in taken.items()) and words["big"] == taken["big"]
    assert mixing.mix_plan(wide.limit(0)).collect() == [] and mixing.mix(wide.limit(0)).collect() == []


def test_mixing_gives_each_of_equal_rows_what_the_plan_takes(spark):
    rows = [(7, "a b c", "en", "rep")] * 40 + [(8, "w", "en", "rep")] * 99 + [(9, "w", "en", "few")] * 3 + [(k, "x y z", "en", "big") for k in range(20)]
    docs = frame(spark, rows, ("size",)).withColumn("size", F.when(F.rand(1) < 0.5, "x"))
    settings = {"share": 0.55, "most": 0.9}
    taken = collections.Counter()
    for r in mixing.mix_plan(docs, **settings).collect():
        taken[r.source] += r.taken
    words = collections.Counter()
    for r in mixing.mix(docs, **settings).collect():
        words[r.source] += len(tokens(r.text))
    assert words == taken and taken["few"] > 0


def check_shards(rows, shards=16):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(0 <= s < shards for s in by)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_sharding_query(spark):
    rows = LLM_QUERIES["op8_sharding"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check_shards(rows)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_hilbert_curve_visits_every_cell_in_unit_steps(spark):
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        side = F.sequence(F.lit(0), F.lit((1 << bits) - 1))
        cells = spark.range(1)
        for k in range(axes):
            cells = cells.withColumn(f"x{k}", F.explode(side)).withColumn(f"at{k}", F.col(f"x{k}"))
        curve = sharding.apply_steps(cells, sharding.hilbert_steps([f"x{k}" for k in range(axes)], bits, "place"))
        path = [r for r in curve.orderBy("place").collect()]
        assert [r.place for r in path] == list(range(1 << (axes * bits)))
        for a, b in itertools.pairwise(path):
            assert sum(abs(a[f"at{k}"] - b[f"at{k}"]) for k in range(axes)) == 1


def test_sharding_edge_cases(spark):
    rows = ([(k, "t" * k, "en", f"https://host{k % 5}") for k in range(50)] + [(3, "same", "de", "hot")] * 33 + [(None, None, None, None)] * 7
            + [(None, "é" * 70000, "fr", ""), (60, "", "fr", None)])
    wide = frame(spark, rows, CLASHING)
    got = sharding.hilbert_shards(wide).collect()
    assert len(got) == len(rows)
    check_shards(got)
    assert {r.text_crc32 for r in got if r["size"] == 1} == {None, 0}
    full = sharding.shard_rows(wide).collect()
    assert collections.Counter((r.doc_id, r.text) for r in full) == collections.Counter(r[:2] for r in rows)
    assert sharding.hilbert_shards(wide.limit(0)).collect() == [] and sharding.shard_rows(wide.limit(0)).collect() == []


def test_sharding_keeps_what_differs_in_other_columns(spark):
    docs = frame(spark, [(1, "same", "en", "s")] * 40 + [(2, "other", "en", "s")]).withColumn("extra", F.monotonically_increasing_id().cast("string"))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    got = sharding.shard_rows(docs).collect()
    assert sorted(r.extra for r in got) == sorted(r.extra for r in docs.collect())
    check_shards(got)


def test_sharding_prunes(spark):
    """Each shard spans a part of each dimension's range, which is what makes files skippable."""
    rows = sharding.shard_rows(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    spans = rows.groupBy("shard").agg(F.countDistinct("source").alias("sources"), F.countDistinct("lang").alias("langs")).collect()
    assert sum(r.sources for r in spans) < 0.75 * 20 * 16 and sum(r.langs for r in spans) < 0.75 * 4 * 16


def test_sharding_writes_one_folder_per_shard(spark, folder):
    docs = frame(spark, [(k, "t" * k, "en", f"s{k % 3}") for k in range(40)])
    sharding.write_shards(docs, f"{folder}/shards")
    back = spark.read.parquet(f"{folder}/shards")
    assert back.count() == 40
    check_shards(back.collect())
