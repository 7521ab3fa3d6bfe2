"""Near duplicates and the pipeline against brute force."""

import itertools
import math
import random

import numpy as np
import pytest

import corpus_pipeline
from helpers import CLASHING, frame, tokens
from sluiceway.llm import embedding_links, jaccard_join
from sluiceway.llm.components import connected_components
from sluiceway.llm.jaccard_join import Join
from sluiceway.llm.queries import LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(1000, k) for k in range(1001, 1060)]
    others = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    links = chain + star + others + chain[:5] + [(b, a) for a, b in star[:5]] + [(7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    links = [x for x in links if x[0] != x[1]]
    want = roots({x for pair in links for x in pair}, links)
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_jaccard(docs, n, percent):
    sets = []
    for _, text in docs:
        w = tokens(text)
        sets.append({tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    ids = [d for d, _ in docs]
    links = [(ids[a], ids[b]) for a, b in itertools.combinations(range(len(docs)), 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    up = roots(set(ids), links)
    return sorted((d, len(s), up[d]) for d, s in zip(ids, sets))


def families(seed, count):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    common = " ".join(rng.choices(vocabulary, k=25))
    docs = []
    while len(docs) < count:
        base = rng.choices(vocabulary, k=rng.choice([2, 3, 5, 9, 30, 60, 120]))
        for _ in range(rng.choice([1, 1, 2, 6])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            docs.append(" ".join(words) + (" " + common if rng.random() < 0.3 else ""))
    return list(enumerate(docs[:count], start=10))


@pytest.mark.parametrize("join", [Join(), Join(n=5, percent=80, pairs=2, block=4, rounds=1)])
def test_jaccard_join_equals_brute_force(spark, join):
    docs = families(join.n, 160) + [(1, "A b C d e"), (2, "a B c D e"), (3, "one"), (4, "ONE"), (5, ""), (6, None), (7, " \t\n"), (8, "x y z")]
    docs += [(k, " ".join(f"c{j}" for j in range(40) if j != k - 900)) for k in range(900, 912)]
    got = jaccard_join.jaccard_components(frame(spark, docs, CLASHING), join)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_jaccard(docs, join.n, join.percent)


def test_jaccard_join_edge_cases(spark):
    long = " ".join(f"v{k}" for k in range(20000))
    docs = [(1, long), (2, long + " more"), (3, "a b c d e"), (3, "a b c d e"), (None, "a b c d e"), (None, "lonely text of its own"), (9, None), (None, None)]
    got = jaccard_join.jaccard_components(frame(spark, docs)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 0), (0, 3), (1, 1), (2, 1), (3, 3), (3, 3), (9, 9)]
    kept = jaccard_join.one_per_component(frame(spark, docs, CLASHING))
    assert sorted((r.doc_id or 0, (r.text or "")[:3]) for r in kept.collect()) == [(0, ""), (0, "lon"), (1, "v0 "), (3, "a b"), (9, "")]
    assert jaccard_join.jaccard_components(frame(spark, docs).limit(0)).collect() == []


def brute_links(rows, threshold=0.98):
    usable = [(i, lab, v) for i, v, lab in rows if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    count, links = {i: 0 for i, _, _ in rows if i is not None}, []
    for (i, a, u), (j, b, v) in itertools.combinations(usable, 2):
        if a == b and len(u) == len(v):
            u, v = np.array(u, dtype="float64"), np.array(v, dtype="float64")
            if u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= threshold:
                count[i] += 1
                count[j] += 1
                links.append((i, j))
    up = roots(set(count), links)
    return sorted((i, count[i], up[i]) for i in count)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", "x", "x") for i, v, lab in rows],
                                 "vec_id long, embedding array<float>, label int, cls string, leaf string, members string")


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, k = [], 0
    for label in (1, 2):
        for _ in range(60):
            base = rng.standard_normal(16)
            for _ in range(int(rng.choice([1, 1, 2, 5]))):
                rows.append((k, (base * 3 + rng.standard_normal(16) * rng.choice([0, 0.05, 0.3])).astype("float32").tolist(), label))
                k += 1
    dense = rng.standard_normal(16)
    rows += [(k + j, (dense + 0.02 * rng.standard_normal(16)).astype("float32").tolist(), 1) for j in range(60)]
    odd = [(5000, None, 1), (5001, [0.0] * 16, 1), (5002, [float("nan")] + [1.0] * 15, 1), (5003, [None] + [1.0] * 15, 1), (5004, [1.0] * 16, None),
           (5005, [1.0] * 16, 1), (5006, [2.0] * 16, 1), (5007, [1.0] * 16, 2), (5008, [1.0, 2.0], 1), (5009, [float("inf")] * 16, 1), (5010, [], 1),
           (5011, [1e-30] * 16, 1), (None, [1.0] * 16, 1)]
    forest = embedding_links.Forest(leaf=12, block=7)
    got = embedding_links.embedding_links(vectors(spark, rows + odd), forest=forest).collect()
    assert len(got) == len(rows + odd) and all(r.kept == (r.vec_id == r.component_id) for r in got)
    found = sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id is not None)
    want = brute_links(rows + odd)
    assert sum(n for _, n, _ in found) >= 0.97 * sum(n for _, n, _ in want)
    assert all(f[1] <= w[1] for f, w in zip(found, want)) and sum(f == w for f, w in zip(found, want)) > 0.95 * len(want)
    assert embedding_links.embedding_links(vectors(spark, rows).limit(0)).collect() == []


def test_embedding_links_of_repeated_ids(spark):
    def near(x):
        return [1.0, float(x), 0.0]
    rows = [(1, near(0), 1), (2, near(0.01), 1), (1, [0.0, 1.0, 0.0], 1), (3, [0.01, 1.0, 0.0], 1), (3, [0.0, 0.0, 1.0], 1), (3, near(0), 2), (3, near(0), 2), (9, near(0.02), 1)]
    got = embedding_links.embedding_links(vectors(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (3, 1, 1), (3, 1, 3), (3, 1, 3), (9, 2, 1)]


def test_embedding_recall_of_the_default_forest(spark):
    """Labels of several thousand vectors, so that trees split; near vectors lie anywhere about the threshold."""
    rng = np.random.default_rng(8)
    per_label = []
    for _ in range(2):
        base = rng.standard_normal((1500, 32))
        copies = rng.integers(1, 5, len(base))
        made = np.repeat(base, copies, axis=0)
        noise = rng.choice([0.02, 0.1, 0.14, 0.2], len(made))[:, None]
        per_label.append((made + noise * rng.standard_normal(made.shape)).astype("float32"))
    rows = [(k * 100_000 + i, v.tolist(), k) for k, made in enumerate(per_label) for i, v in enumerate(made)]
    got = {r.vec_id: r for r in embedding_links.embedding_links(vectors(spark, rows)).collect()}
    found = wanted = 0
    for k, made in enumerate(per_label):
        assert len(made) > 4 * embedding_links.Forest().leaf
        unit = made.astype("float64")
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        for i, want in enumerate((unit @ unit.T >= 0.98).sum(axis=1) - 1):
            assert got[k * 100_000 + i].n_links <= want
            found, wanted = found + got[k * 100_000 + i].n_links, wanted + want
    assert wanted > 4000 and found >= 0.97 * wanted


def test_embedding_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = LLM_QUERIES["op6_embedding_links"](spark, SF_DIR).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute_links(rows)


def test_pipeline_keeps_what_each_stage_keeps(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    near = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
    assert near.columns == docs.columns
    want = {c for _, _, c in brute_jaccard([(r.doc_id, r.text) for r in docs.collect()], 5, 80)}
    assert {r.doc_id for r in near.collect()} == want
    out = corpus_pipeline.run(spark, SF_DIR)
    assert set(docs.columns) <= set(out.columns)
    by = {}
    for r in out.collect():
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and {r.doc_id for r in out.select("doc_id").collect()} <= want
