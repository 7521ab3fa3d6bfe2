"""Substring dedup and license scan against plain Python."""

import random
import re
import textwrap
from collections import Counter

import zstandard
from helpers import CLASHING, frame
from sluiceway.llm import licenses, substring_dedup
from sluiceway.llm.queries import LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\s!-/:-@\[-`{-~\x00-\x1f\x7f]+", text.lower())


def compared(pieces, least):
    """All runs of pieces that the rule compares: whole lines, long pieces, and the shortest long run from or to a short piece."""
    worded = [k for k, p in enumerate(pieces) if words_of(p)]
    count = {k: len(words_of(pieces[k])) for k in worded}
    line, lines = 0, {}
    for k, piece in enumerate(pieces):
        if k in count:
            lines.setdefault(line, []).append(k)
        line += "\n" in piece
    runs = {(ks[0], ks[-1]) for ks in lines.values()}
    for n in range(len(worded)):
        for step in (1, -1):
            have, m = 0, n
            while 0 <= m < len(worded) and have < least:
                have += count[worded[m]]
                m += step
            if have >= least:
                runs.add((worded[min(n, m - step)], worded[max(n, m - step)]))
    return runs


def brute_dedup(docs, unit="sentence", least=5):
    """Runs in the order of documents and places: of equal ones the first stays, whatever is behind it in the later ones goes."""
    rows, found = sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0)), {}
    split = {doc: re.findall(substring_dedup.UNITS[unit], text or "") for doc, text in rows}
    for doc, text in rows:
        assert "".join(split[doc]) == (text or "")
        for first, last in sorted(compared(split[doc], least)):
            found.setdefault(" ".join(words_of("".join(split[doc][first:last + 1]))), []).append((doc, first, last))
    gone = {}
    for places in found.values():
        for doc, first, last in places[1:]:
            start = max(first, places[0][2] + 1) if doc == places[0][0] else first
            gone.setdefault(doc, set()).update(range(start, last + 1))
    return {doc: substring_dedup.cut_units(text, sorted(gone[doc]), unit, least) if gone.get(doc) else (text, []) for doc, text in rows}


def test_dedup_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_dedup(docs)
    got = LLM_QUERIES["op2_substring_dedup"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.text, [s.asDict() for s in r.removed]) for r in got} == want and len(got) == len(docs)
    assert any(spans for _, spans in want.values()) and not all(spans for _, spans in want.values())


def test_dedup_removes_a_planted_passage_and_nothing_else(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=5))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(6, 14))).capitalize() + "."
    passage = " ".join(sentence() for _ in range(7)) + " Yes. " + sentence()
    docs = [(k, " ".join(sentence() for _ in range(4)) + (f" {passage} " if k % 3 == 0 else " ") + sentence()) for k in range(30)]
    got = {r.doc_id: r for r in substring_dedup.dedup_substrings(frame(spark, docs)).collect()}
    for doc, text in docs:
        if doc % 3 or doc == 0:
            assert got[doc].text == text and got[doc].removed == []
        else:
            assert [text[s.start:s.end].strip() for s in got[doc].removed] == [passage]
            assert got[doc].n_chars == len(got[doc].text) == len(text) - sum(s.end - s.start for s in got[doc].removed)


def test_dedup_edge_cases(spark):
    line = "One two three four five six."
    docs = [(2, f"{line} Tail of its own that stays here."), (1, line.upper()), (1, line.upper()), (3, None), (4, ""), (5, "a. b. a. b."),
            (None, f"intro\n{line}"), (6, (line + " ") * 5000), (7, "É é.\n\n\n")]
    wide = frame(spark, docs, CLASHING)
    got = substring_dedup.dedup_substrings(wide)
    assert got.columns == [*wide.columns, "removed"] and got.count() == len(docs)
    found = {r.doc_id: (r.text, [s.asDict() for s in r.removed]) for r in got.collect()}
    assert found == brute_dedup(docs)
    assert found[None][1] == [] and found[1][0] == "" and found[6][0] == ""
    assert substring_dedup.dedup_substrings(wide.limit(0)).collect() == []


def test_dedup_short_units_edges_and_lines(spark):
    long = "One two three four five six."
    docs = [(1, f"Oh no. Not now. {long} So be it. Yes."), (2, f"Oh no. Not now. {long} So be it. Yes."),
            (3, f"Fresh words stand at the front here. Oh no. Not now. {long} So be it. Yes. No."), (4, "Menu\nContact us.\n--\n"), (5, "Menu\nContact us.\n--\n"),
            (6, f"Yes. It is. Hm. {long} Never before."), (7, "Ha. Ha. Ha. Ha. Ha. Ha. Ha."), (8, "Tiny"), (9, "Tiny")]
    got = {r.doc_id: r.text for r in substring_dedup.dedup_substrings(frame(spark, docs)).collect()}
    assert got == {**dict(docs), 2: "", 3: "Fresh words stand at the front here. No.", 5: "", 6: "Yes. It is. Hm. Never before.",
                   7: "Ha. Ha. Ha. Ha. Ha. ", 9: ""}


def test_dedup_leaves_nothing_of_later_exact_copies(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    first = {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        first.setdefault(text, doc)
    copies = {doc for doc, text in docs if first[text] != doc and re.search(r"\w", text or "")}
    got = {r.doc_id: r.text for r in LLM_QUERIES["op2_substring_dedup"](spark, "/root/testdata/sf0.01").collect()}
    assert copies and all(got[doc] == "" for doc in copies)


def test_every_notice_is_found_under_its_name():
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            assert licenses.match(text)[0] == name, (name, text)
            assert licenses.match(f"/* {text.upper()}  */")[0] == name
    near = licenses.match("Licensed under the Apache Licence, Version 2.0")
    assert near[0] == "Apache-2.0" and sorted(near[3]) == ["licence", "license"]
    assert licenses.match("the licensed premises were closed for repairs") is None and licenses.match("") is None


def test_license_scan_edge_cases(spark):
    docs = [(1, "text\nReleased under the MIT License.\nmore"), (1, "text\nReleased under the MIT License.\nmore"), (2, None), (3, ""),
            (4, "no notice, but a license to kill"), (None, "All rights reserved."), (5, "word " * 30000 + "\nLicensed under CC BY-NC 4.0.")]
    wide = frame(spark, docs, CLASHING)
    got = sorted(((r.doc_id or 0, r.line, r.license, r.exact) for r in licenses.scan_licenses(wide).collect()))
    assert got == [(0, 0, "proprietary", True), (1, 1, "MIT", True), (1, 1, "MIT", True), (5, 1, "CC-BY-NC-4.0", True)]
    assert licenses.scan_licenses(wide.limit(0)).collect() == []


def test_license_query_finds_the_planted_lines(spark):
    planted = {"All rights reserved.": "proprietary", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT",
               "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    want = sorted((r.doc_id, k, planted[line]) for r in texts for k, line in enumerate(r.text.split("\n")) if line in planted)
    got = sorted((r.doc_id, r.line, r.license) for r in LLM_QUERIES["op7_licenses"](spark, SF_DIR).collect())
    assert set(want) <= set(got) and len(got) - len(want) <= 1


def wrapped(text, mark, width=72):
    return "\n".join(f"{mark}{line}" for line in textwrap.wrap(text, width))


def test_wrapped_notices_are_found_with_their_lines(spark):
    docs, want = [], []
    for name in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "AGPL-3.0", "MPL-2.0", "EPL-2.0", "ISC", "Unlicense"):
        body = wrapped(licenses.TEMPLATES[name][-1], (" * ", "# ", "")[len(docs) % 3])
        docs.append((len(docs), f"Some words before.\n\n{body}\n\nint main() and so on."))
        want.append((len(want), name, 2, 2 + body.count("\n"), True))
    got = sorted((r.doc_id, r.license, r.line, r.last_line, r.exact) for r in licenses.scan_licenses(frame(spark, docs)).collect())
    assert got == want and all(last > first for _, _, first, last, _ in got)


def test_all_notices_of_a_line_are_found():
    filler = "so it went on for a while with these and other words of no account "
    line = f"Released under the MIT License. All rights reserved. {filler * 40} Licensed under the Apache License, Version 2.0. {filler}"
    found = licenses.notices(line)
    assert [f["license"] for f in found] == ["MIT", "proprietary", "Apache-2.0"] and all(not f["differences"] for f in found)
    assert line[found[1]["start"]:found[1]["end"]] == "All rights reserved"
    near = "This book is licensed under the GNU General Public License, version 3."
    alone, = licenses.notices(near)
    late, = licenses.notices(f"In this chapter nothing of note was said by this man. {filler} {near} {filler}")
    assert alone["license"] == late["license"] == "GPL-3.0" and alone["differences"] == late["differences"]
    assert len(licenses.notices("All rights reserved.\n" * 300)) == 300


def in_order(notice, words):
    """How many words of both stand in the same order in both, by the plain table."""
    row = [0] * (len(words) + 1)
    for a in notice:
        left = 0
        for j, b in enumerate(words, 1):
            left, row[j] = row[j], left + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def saved_bytes(notice, words):
    """What the notice as raw dictionary saves of the words, by a compressor made for this one question."""
    data = " ".join(words).encode()
    known = zstandard.ZstdCompressionDict(" ".join(notice).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return len(licenses._compressor().compress(data)) - len(licenses._compressor(known).compress(data))


def every_place(words):
    """All (license, start, end, saved) over all windows and all notices."""
    for name, texts in licenses.TEMPLATES.items():
        for notice in map(licenses._words, texts):
            least = 0.8 * len(notice)
            for start in range(len(words)):
                for end in range(start + 1, min(len(words), start + int(1.5 * len(notice)) + 2) + 1):
                    window = words[start:end]
                    if words[start] in notice and window[-1] in notice and (Counter(window) & Counter(notice)).total() >= least:
                        if in_order(notice, window) >= least and (saved := saved_bytes(notice, window)) > 0:
                            yield name, start, end, saved


def test_license_scan_against_all_windows_and_notices():
    rng = random.Random(4)
    filler = lambda n: [rng.choice("so it went on for a while with these and other words of no account".split()) for _ in range(n)]
    notices = [(name, licenses._words(text)) for name, texts in licenses.TEMPLATES.items() for text in texts if len(licenses._words(text)) < 30]
    for _ in range(12):
        words, planted = [], 0
        for name, notice in rng.sample(notices, 2):
            notice = list(notice)
            if len(notice) > 9:
                notice[rng.randrange(1, len(notice) - 1)] = "changed"
            words += filler(rng.randint(0, 90)) + notice
            planted += 1
        words += filler(rng.randint(0, 20))
        found, places = licenses.find_all(words), list(every_place(words))
        assert planted and places and found
        # Whatever any window and notice give is found or lies over something found.
        assert all(any(f.start < end and start < f.end for f in found) for _, start, end, _ in places)
        for f in found:
            same = {name: saved for name, start, end, saved in places if (start, end) == (f.start, f.end)}
            assert f.license in same and same[f.license] == max(same.values()) == f.rank[0]
        assert all(a.end <= b.start for a, b in zip(found, found[1:]))


def test_license_blocks_do_not_show_in_the_result(monkeypatch):
    text = licenses._words(" ".join(["so it went on"] * 30 + [licenses.TEMPLATES["BSD-3-Clause"][-1]] + ["and other words"] * 50 + ["All rights reserved."]))
    want = [(f.license, f.start, f.end, f.differences) for f in licenses.find_all(text)]
    for size in (16, 40, 256):
        monkeypatch.setattr(licenses, "_BLOCK", size)
        assert [(f.license, f.start, f.end, f.differences) for f in licenses.find_all(text)] == want
    assert [w[0] for w in want] == ["BSD-3-Clause", "proprietary"] and licenses.find_all([]) == []
