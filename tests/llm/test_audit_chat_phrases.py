"""Chat formatting, filter audit and collocations against plain Python."""

import collections
import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import CLASHING, frame, lower
from sluiceway.llm import chat_format, collocations, filter_audit
from sluiceway.llm.chat_format import Template, encode_text, encoding
from sluiceway.llm.collocations import Mining

TALK = "conv_id long, turn long, role string, text string"


def brute_talk(rows, template=Template()):
    """Digests from the rows themselves, lengths from the template's strings."""
    marks, by = dict(template.marks), collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        by[conv].append((turn is not None, turn or 0, hashlib.md5(f"{role}\n{text}".encode()).hexdigest(), role, text))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        said = "".join(t[4] for t in turns if t[3] == "assistant")
        written = template.begin + "".join(
            (marks.get(r) or template.role + template.escape(r) + template.role_end) + template.escape(x) + template.end for *_, r, x in turns)
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest(), len(said),
                     hashlib.sha256(said.encode()).hexdigest(), len(written))
    return out


def test_escaping_is_reversible_and_hides_every_control_string():
    rng, template = random.Random(3), Template()
    bits = [*template.controls(), "\\", "\\\\", "<", "/s>", "[", "INST]", "é", " ", "<\\s>", "[\\\\/INST]"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 12)))
        hidden = template.escape(text)
        assert template.unescape(hidden) == text and not any(c in hidden for c in template.controls())
    with pytest.raises(ValueError):
        Template(begin="<<SYS>>")
    with pytest.raises(ValueError):
        Template(begin="</s>")


@pytest.mark.parametrize("slice_turns", [1024, 2])
def test_chat_edge_cases(spark, slice_turns):
    rows = [(1, 0, "user", "Hi </s> there"), (1, 1, "assistant", "[/INST]<\\s> é漢字🙂"), (1, 2, "user", None), (1, 3, "assistant", ""),
            (1, 4, "assistant", "two in"), (1, 5, "assistant", " a row"), (2, 0, None, "no role"), (2, 1, "tool<s>", "x"), (2, None, "system", "first"),
            (None, 0, "user", "nameless"), (3, 7, "assistant", "tie b"), (3, 7, "assistant", "tie a"), (3, 7, "assistant", "tie a"), (3, 7, "user", "tie"),
            (4, 0, "assistant", "a" * 50_000 + " \n" + "é b" * 30_000), (5, 0, "", "\x00\x1c ")] + [(6, k, "user", f"turn {k}") for k in range(40)]
    wide = spark.createDataFrame(rows, TALK).select("*", *(F.lit("x").alias(c) for c in CLASHING if c not in ("turn", "text", "role")))
    pieces = chat_format.format_chat(wide, slice_turns=slice_turns)
    got = {r.conv_id: tuple(r)[1:] for r in chat_format.read_back(pieces).collect()}
    assert got == brute_talk(rows)
    by = collections.defaultdict(list)
    for r in pieces.collect():
        by[r.conv_id].append(r)
    first = encoding(chat_format.TOKENIZER).n_vocab
    for turns in by.values():
        at = 0
        for r in sorted(turns, key=lambda r: r.start):
            assert r.start == at and len(r.input_ids) == len(r.loss_mask) and (r.input_ids[0] == first) == (at == 0)
            at += len(r.input_ids)
    assert chat_format.read_back(chat_format.format_chat(wide.limit(0))).collect() == []


def test_no_text_is_encoded_to_a_reserved_id():
    text = "".join(Template().controls()) * 50 + "<|endoftext|>"
    ids = encode_text(text, chat_format.TOKENIZER)
    encoder = encoding(chat_format.TOKENIZER)
    assert max(ids) < encoder.n_vocab and encoder.decode_bytes(ids).decode() == text


def brute_audit(docs, labels):
    marks = collections.defaultdict(lambda: [0, 0])
    for doc, quality, toxic in labels:
        marks[doc] = [max(marks[doc][0], quality == 1), max(marks[doc][1], toxic == 1)]
    first = {}
    for doc, text, _ in docs:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    seen = []
    for doc, text, source in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": doc is not None and doc > first[t]}
        seen.append((source or "", {f for f in fails if fails[f]}, *(marks[doc] if doc is not None else [0, 0])))
    out = {}
    for part in {s[0] for s in seen}:
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                row = [0] * 6
                for _, fails, good, toxic in (s for s in seen if s[0] == part):
                    here = not fails & set(order[:k])
                    removed = here and f in fails
                    for i, hit in enumerate((here and not removed, removed, f in fails and not here, fails == {f}, removed and good, removed and toxic)):
                        row[i] += bool(hit)
                out[part, "".join(order), k + 1] = row
                shapley[f] += row[1]
        for (p, order, k), row in out.items():
            if p == part:
                row.append(shapley[order[k - 1]])
    return {(*k, *v) for k, v in out.items()}


def test_audit_edge_cases(spark):
    long = " ".join(f"w{k}" for k in range(250))
    docs = [(1, long, "a"), (2, long, "b"), (3, long + " #", "a"), (4, "A B c", "a"), (5, "x " * 300, None), (6, None, ""), (7, "", "a"), (8, None, "b"),
            (None, long, "a"), (None, None, "c"), (9, "é Z " * 210, "b"), (9, "other", "b"), (10, long, "a"), (10, long, "a"), (1, long, "a"), (11, "v" * 60_000, "c")]
    labels = [(1, 1, 0), (2, 0, 1), (2, None, 0), (10, 1, 1), (9, 1, None), (None, 1, 1), (99, 1, 1)]
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("rows", F.lit("x"))
    wide = frame(spark, [(i, t, "en", s) for i, t, s in docs], CLASHING + ("quality", "toxic", "mask", "good", "part", "t", "is"))
    got = [tuple(r) for r in filter_audit.filter_audit(wide, marked).collect()]
    assert len(got) == 600 * 4 and set(got) == brute_audit(docs, labels)
    assert filter_audit.filter_audit(wide.limit(0), marked).collect() == []
    assert {r[3] + r[4] + r[5] >= 0 for r in map(tuple, filter_audit.filter_audit(wide, marked.limit(0)).collect())} == {True}


def brute_collocations(docs, longest=3, least=10, top=2000, percent=50):
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for m in range(1, longest + 1):
                counts[lang or "und"].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            if any(100 * b >= percent * a for q, b in candidates.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, n + 1, p.decode(), -a, x, y, total[lang], -s) for n, (s, a, p, x, y) in enumerate(sorted(rows)[:top])]
    return sorted(out, key=str)


TINY = {"burst": 4, "entries": 60, "words": 40, "slots": 4, "block": 50}


@pytest.mark.parametrize("settings", [{}, TINY, {"longest": 4, **TINY}, {"longest": 2, "top": 7, "least": 3, **TINY}])
def test_collocations_edge_cases(spark, settings):
    rng = random.Random(5)
    word = lambda: f"W{min(int(rng.expovariate(0.3)), 30)}é"
    texts = [" ".join(word() for _ in range(rng.randint(0, 60))) + rng.choice([".", "!\n", "\t", ""]) for _ in range(150)]
    docs = [(rng.choice(["en", "de", None]), t) for t in texts] + [("en", None), ("en", ""), (None, "...,"), ("xx", "one two"), ("en", "same line here " * 400)]
    docs += [("en", "New York city, \x00nul x y")] * 30 + [("de", "solange " + "z" * 3000)] * 12
    wide = frame(spark, [(k, t, lang, "s") for k, (lang, t) in enumerate(docs)], CLASHING + ("phrase", "a", "l", "r", "n", "rank", "slice2", "k"))
    got = collocations.mine_collocations(wide, Mining(**settings))
    plain = {k: settings[k] for k in ("longest", "least", "top") if k in settings}
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_collocations(docs, **plain)
    assert collocations.mine_collocations(wide.limit(0), Mining(**settings)).collect() == []


def test_large_products_are_exact(spark):
    a = 4_000_000_000_000
    rows = spark.createDataFrame([("en", "x y", a), ("en", "x", a + 1), ("en", "y", a + 7), ("en", "", 10 * a)], "lang string, phrase string, n long")
    got = collocations.score_phrases(rows).collect()
    assert [(r.l, r.r, r.score) for r in got] == [(a + 1, a + 7, 1000000 * a * a // ((a + 1) * (a + 7)))]
