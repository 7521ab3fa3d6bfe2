"""License scan by conditional compression: which known notices shorten a passage, and how its wording differs."""

from __future__ import annotations

import bisect
import difflib
import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import text_key

# Public license notices, as they are commonly worded. Where several fit, the one of most words counts.
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files")
_MIT_REST = (" (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
             "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
             "to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all "
             "copies or substantial portions of the Software.")
_AS_IS = (" THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
          "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
          "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
          "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met")
_BSD_TWO = (": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
            "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
            "in the documentation and/or other materials provided with the distribution.")
_BSD_THIRD = (" 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
              "derived from this software without specific prior written permission.")
_BSD_END = (" THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
            "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
            "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
            "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
            "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
            "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.")
_ISC_END = (" THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
            "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
            "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
            "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_UNLICENSE = "This is free and unencumbered software released into the public domain."
_UNLICENSE_REST = (" Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
                   "compiled binary, for any purpose, commercial or non-commercial, and by any means.")
_APACHE = "Licensed under the Apache License, Version 2.0"
_APACHE_USE = (" (the \"License\"); you may not use this file except in compliance with the License. "
               "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0")
_APACHE_END = (" Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
               "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
               "governing permissions and limitations under the License.")


def _gnu(kind: str, version: str) -> tuple[str, ...]:
    """The notices that name a license of the GNU family: the grant alone, and with its disclaimer."""
    what = {"": "program", "Lesser ": "library", "Affero ": "program"}[kind]
    grant = (f"This {what} is free software{{}} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License "
             f"as published by the Free Software Foundation{{}} either version {version} of the License, or (at your option) any later version.")
    no_warranty = (f" This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                   f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details. You should "
                   f"have received a copy of the GNU {kind}General Public License along with this {what}.")
    grant = grant.format(":", ",") if version.startswith("3") else grant.format(";", ";")
    return (f"This work is licensed under the GNU {kind}General Public License, version {version[0]}.", grant, grant + no_warranty)


TEMPLATES = {
    "Apache-2.0": (_APACHE + ".", _APACHE + _APACHE_USE, _APACHE + _APACHE_USE + _APACHE_END),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", _MIT, _MIT + _MIT_REST, _MIT + _MIT_REST + _AS_IS),
    # The sentence that both begin with does not tell them apart.
    "BSD": (_BSD,),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", _BSD + _BSD_TWO, _BSD + _BSD_TWO + _BSD_END),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", _BSD + _BSD_TWO + _BSD_THIRD, _BSD + _BSD_TWO + _BSD_THIRD + _BSD_END),
    "ISC": ("Licensed under the ISC License.", _ISC, _ISC + _ISC_END),
    "Unlicense": (_UNLICENSE, _UNLICENSE + _UNLICENSE_REST),
    "GPL-3.0": _gnu("", "3"),
    "GPL-2.0": _gnu("", "2"),
    "LGPL-3.0": _gnu("Lesser ", "3"),
    "LGPL-2.1": _gnu("Lesser ", "2.1")[1:],
    "AGPL-3.0": _gnu("Affero ", "3"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
                "this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
                "available at https://www.eclipse.org/legal/epl-2.0/",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.",),
    "proprietary": ("All rights reserved.",),
}
#: A text without any of these is no candidate. Notices may be wrapped, and stand in comments.
HINT = r"(?i)licen[cs]e|copyright|permission|redistribut|free software|rights\W+reserved|creative\W+commons|\bcc\W*(?:by|0)|public\W+domain"
#: Words in a block that is compressed with every notice; the next block starts half a block later.
_BLOCK = 64
_WORDS = re.compile(r"[A-Za-z0-9]+(?:\.+[A-Za-z0-9]+)*")


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORDS.findall(text)]


def _compressor(known: zstandard.ZstdCompressionDict | None = None) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
        strategy=zstandard.STRATEGY_LAZY2, min_match=4, window_log=14, hash_log=10, chain_log=10, search_log=4, target_length=32)
    if known is None:
        return zstandard.ZstdCompressor(compression_params=settings)
    known.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=settings)


@lru_cache(1)
def _models() -> list[tuple[str, list[str], zstandard.ZstdCompressor]]:
    return [(name, _words(text), _compressor(zstandard.ZstdCompressionDict(
        " ".join(_words(text)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))) for name, texts in TEMPLATES.items() for text in texts]


@lru_cache(1)
def _alone() -> zstandard.ZstdCompressor:
    return _compressor()


class Found(NamedTuple):
    """A notice in a text: its first word and the one after its last; ``differences`` are words only one side has, and
    ``rank`` orders notices: bytes saved, then fewer differences, then words shared."""

    license: str
    reduction: float
    share: float
    differences: list[str]
    start: int
    end: int
    rank: tuple[int, int, int]


def _longest(a: list[str], b: list[str]) -> difflib.Match:
    return difflib.SequenceMatcher(None, a, b, autojunk=False).find_longest_match()


def _runs(a: list[str], b: list[str]) -> list[difflib.Match]:
    return [r for r in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if r.size]


def _aligned(k: int, words: list[str], near: difflib.Match, low: int, high: int, least: float) -> Found | None:
    """The notice ``k`` around the run ``near`` that it shares with ``words[low:high]``, if enough of it stands there.

    Both sides are aligned away from the run, so that the words nearest to it count, and end where the notice would.
    """
    name, notice, model = _models()[k]
    most = 1.5 * len(notice) + 2
    before, after = near.a, len(notice) - near.a - near.size
    left = words[max(low, near.b - int(1.5 * before + 2)):near.b][::-1]
    right = words[near.b + near.size:min(high, near.b + near.size + int(1.5 * after + 2))]
    runs = [(near.b - r.b - r.size, r.size) for r in _runs(notice[:before][::-1], left)][::-1] + [(near.b, near.size)] + [
        (near.b + near.size + r.b, r.size) for r in _runs(notice[near.a + near.size:], right)]
    # A notice scattered over a long block is none: stray words at its ends do not count.
    while runs[-1][0] + runs[-1][1] - runs[0][0] > most:
        runs.pop(0 if runs[0][1] < runs[-1][1] else -1)
    shared = sum(size for _, size in runs)
    if shared < least * len(notice):
        return None
    start, end = runs[0][0], runs[-1][0] + runs[-1][1]
    data = " ".join(words[start:end]).encode()
    alone = len(_alone().compress(data))
    saved = alone - len(model.compress(data))
    if saved <= 0:
        return None
    differs = [w[2:] for w in difflib.ndiff(notice, words[start:end]) if w[0] in "+-"] if notice != words[start:end] else []
    return Found(name, saved / alone, shared / len(notice), differs, start, end, (saved, -len(differs), shared))


def _of_notice(k: int, words: list[str], low: int, high: int, least: float) -> list[Found]:
    """All places of the notice ``k`` in ``words[low:high]``, none over another."""
    notice, found, left = _models()[k][1], [], []
    counts = Counter(notice)
    # Exact ones first, in one pass: a text may hold very many.
    for at in range(low, high - len(notice) + 1):
        if at >= low and words[at] == notice[0] and words[at:at + len(notice)] == notice:
            place = _aligned(k, words, difflib.Match(0, at, len(notice)), low, high, least)
            found += [place] if place else []
            left.append((low, at))
            low = at + len(notice)
    left.append((low, high))
    while left:
        low, high = left.pop()
        if (Counter(words[low:high]) & counts).total() < least * len(notice):
            continue
        near = _longest(notice, words[low:high])
        near = difflib.Match(near.a, near.b + low, near.size)
        place = _aligned(k, words, near, low, high, least)
        start, end = (place.start, place.end) if place else (near.b, near.b + near.size)
        found += [place] if place else []
        left += [(low, start), (end, high)]
    return found


def _savings(data: bytes) -> list[tuple[int, int]]:
    """(notice, bytes saved) of all notices that make a block shorter as dictionary."""
    alone = len(_alone().compress(data))
    saved = [(k, alone - len(model.compress(data))) for k, (_, _, model) in enumerate(_models())]
    return [(k, n) for k, n in saved if n > 0]


def _shortened(words: list[str], low: int, high: int, known: dict[tuple[int, int], list[tuple[int, int]]]) -> list[tuple[int, int, int]]:
    """(notice, from, to): where blocks of ``words[low:high]`` become shorter with the notice as dictionary, the notices
    that save most in a block first. Blocks overlap by half; those of one notice that touch, widened by as far as the
    notice could reach beyond them, are one stretch. ``known`` remembers blocks."""
    stretches: dict[int, list[list[int]]] = {}
    most: Counter[int] = Counter()
    half = _BLOCK // 2
    for at in range(low // half * half, max(low // half * half + 1, high - half), half):
        block = max(low, at), min(high, at + _BLOCK)
        if block not in known:
            known[block] = _savings(" ".join(words[block[0]:block[1]]).encode())
        for k, saved in known[block]:
            reach = int(1.5 * len(_models()[k][1]) + 2)
            start, end = max(low, block[0] - reach), min(high, block[1] + reach)
            mine = stretches.setdefault(k, [])
            if mine and mine[-1][1] >= start:
                mine[-1][1] = end
            else:
                mine.append([start, end])
            most[k] = max(most[k], saved)
    return [(k, start, end) for k, _ in most.most_common() for start, end in stretches[k]]


def find_all(words: list[str], least: float = 0.8) -> list[Found]:
    """The notices that stand in a list of words, in order, none over another.

    The words are cut into overlapping blocks, and each block is compressed alone and with every notice as dictionary.
    Every notice that makes a block shorter is confirmed around it by its exact wording: it is found where at least
    ``least`` of it stands in order and it shortens that place. Of places that overlap the one is taken where the
    notice saves most bytes, of equal ones that with the fewest differing words, then the one that shares the most;
    what is left between them is cut into blocks and searched again, until no notice is confirmed.
    """
    found: list[Found] = []
    known: dict[tuple[int, int], list[tuple[int, int]]] = {}
    looked: dict[tuple[int, int, int], list[Found]] = {}
    left = [(0, len(words))] if words else []
    while left:
        low, high = left.pop()
        seen = []
        for k, start, end in _shortened(words, low, high, known):
            if (k, start, end) not in looked:
                looked[k, start, end] = _of_notice(k, words, start, end, least)
            seen += looked[k, start, end]
        taken: list[tuple[int, int]] = []
        for place in sorted(seen, key=lambda f: f.rank, reverse=True):
            at = bisect.bisect(taken, (place.start, place.end))
            if (at == 0 or taken[at - 1][1] <= place.start) and (at == len(taken) or place.end <= taken[at][0]):
                taken.insert(at, (place.start, place.end))
                found.append(place)
        if taken:
            edges = [low, *(x for span in taken for x in span), high]
            left += [(a, b) for a, b in zip(edges[::2], edges[1::2]) if a < b]
    return sorted(found, key=lambda f: f.start)


def match(block: str, least: float = 0.8) -> tuple[str, float, float, list[str]] | None:
    """(license, size reduction, share of the notice found, differing words) of the best notice in a block, or None."""
    best = max(find_all(_words(block), least), key=lambda f: f.rank, default=None)
    return best and (best.license, best.reduction, best.share, best.differences)


def notices(text: str) -> list[dict]:
    """The notices of a text with their lines, from 0, and their offsets in characters."""
    at = list(_WORDS.finditer(text))
    found = find_all([m[0].lower() for m in at])
    line = lambda offset: text.count("\n", 0, offset)
    return [{"line": line(at[f.start].start()), "last_line": line(at[f.end - 1].end()), "start": at[f.start].start(), "end": at[f.end - 1].end(),
             "license": f.license, "reduction": f.reduction, "found_share": f.share, "differences": f.differences} for f in found]


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per notice found: doc_id, text_id, line and last_line (from 0), start and end (characters), license,
    reduction, found_share, exact, differences.

    Texts that hold a word of licensing are candidates (found by one pattern, before anything goes to Python); all blocks
    of each are compressed with all templates, across line breaks and comment marks (see ``find_all``). Null and empty texts and
    texts without notices give no rows. Equal rows each give theirs. Other columns are ignored.
    """

    @F.pandas_udf("array<struct<line:int,last_line:int,start:int,end:int,license:string,reduction:double,found_share:double,differences:array<string>>>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([notices(text) for text in texts], dtype="object")

    texts = docs.filter(F.col("text").rlike(HINT)).select("doc_id", text_key(F.col("text")).alias("text_id"), run.asNondeterministic()("text").alias("all"))
    found = texts.select("doc_id", "text_id", F.explode("all").alias("found"))
    return found.select("doc_id", "text_id", "found.line", "found.last_line", "found.start", "found.end", "found.license", "found.reduction",
                        "found.found_share", (F.size("found.differences") == 0).alias("exact"), "found.differences")
