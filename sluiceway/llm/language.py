"""Language identification by cross-parsing: the language whose known text spells a document in the fewest phrases."""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import FRACTION_END, hash_fraction

#: Prediction for texts without a letter.
UNKNOWN = "und"
_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Words whose phrase counts a task remembers before it starts anew.
_REMEMBERED = 200_000


def words(text: str | None) -> list[str]:
    """Runs of letters with their marks, in lower case; numbers of any script are none. Null has none."""
    return _WORDS.findall((text or "").lower())


class SuffixAutomaton:
    """All substrings of a text, one character at a time: ``next[state]`` maps a character to the state after it."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        length, link, last = [0], [-1], 0
        for char in text:
            here = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and char not in self.next[at]:
                self.next[at][char] = here
                at = link[at]
            if at >= 0:
                then = self.next[at][char]
                if length[then] == length[at] + 1:
                    link[here] = then
                else:
                    split = len(self.next)
                    self.next.append(dict(self.next[then]))
                    length.append(length[at] + 1)
                    link.append(link[then])
                    while at >= 0 and self.next[at].get(char) == then:
                        self.next[at][char] = split
                        at = link[at]
                    link[then] = link[here] = split
            last = here

    def phrases(self, text: str) -> int:
        """Into how few known substrings the text falls when each is taken as long as it can be. An unknown character
        counts as one."""
        count, state, moves = 0, 0, self.next
        for char in text:
            then = moves[state].get(char)
            if then is None:
                count += 1
                then = moves[0].get(char, 0)
                if state == 0:
                    continue
                if then == 0:
                    count += 1
            state = then
        return count + (state != 0)


def training_text(texts: Iterable[str], chars: int) -> str:
    """The first words of the texts, each between spaces, up to ``chars`` characters; a word is taken once."""
    seen: dict[str, None] = {}
    left = chars
    for text in texts:
        for word in words(text):
            if word not in seen:
                left -= len(word) + 1
                if left < 0:
                    return f" {' '.join(seen)} "
                seen[word] = None
    return f" {' '.join(seen)} "


def training_texts(docs: DataFrame, rows: int = 200, chars: int = 20_000, longest: int = 20_000, fold: int = 3,
                   held_out: int = 1) -> dict[str, str]:
    """For each language in ``lang``, text of at most ``chars`` characters out of about ``rows`` documents.

    Documents are picked by a hash; those whose crc32(doc_id) leaves ``held_out`` modulo ``fold`` never are, nor those
    without language. Of a long document the first ``longest`` characters are fetched. The languages are counted first, so that what reaches the driver is
    bounded per language.
    """
    chance = hash_fraction(F.lit("language"), F.col("doc_id"))
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                         & ((F.crc32(F.col("doc_id").cast("string")) % fold) != held_out))
    sizes = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 2 * rows / n))))
    picked = usable.filter(chance < share[F.col("lang")] * float(FRACTION_END)).select("lang", F.left("text", F.lit(longest)).alias("text"), chance.alias("chance"))
    found = sorted(picked.collect(), key=lambda r: (r.lang, r.chance, r.text))
    texts = {lang: training_text([r.text for r in found if r.lang == lang][:rows], chars) for lang in sorted(sizes)}
    return {lang: text for lang, text in texts.items() if text.strip()}


@lru_cache(2)
def _automata(texts: tuple[tuple[str, str], ...]) -> list[SuffixAutomaton]:
    return [SuffixAutomaton(text) for _, text in texts]


def predict(texts: pd.Series, known: dict[str, str]) -> pd.DataFrame:
    """``lang_pred`` and ``score`` for each text."""
    names = list(known)
    automata = _automata(tuple(known.items()))

    @lru_cache(_REMEMBERED)
    def phrases(word: str) -> tuple[int, ...]:
        return tuple(a.phrases(f" {word} ") for a in automata)

    langs, scores = [], []
    for text in texts:
        counts = list(map(phrases, words(text)))
        if not counts or not names:
            langs.append(UNKNOWN)
            scores.append(0.0)
            continue
        total = np.sum(np.array(counts, dtype="int64"), axis=0)
        best = int(np.argmin(total))
        rest = np.delete(total, best)
        langs.append(names[best])
        scores.append(float(rest.min() / (rest.min() + total[best])) if len(rest) else 1.0)
    return pd.DataFrame({"lang_pred": langs, "score": scores})


def identify(docs: DataFrame, known: dict[str, str]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; other columns stay, and a column of these names is replaced.

    Each language's training text is a suffix automaton. A document is parsed against each, word by word: the longest
    substring that the automaton knows, then the next from there. The fewest phrases win, the first language on a tie.
    ``score`` is the runner-up's share of the two lowest counts, from 0.5 for a tie towards 1. Null text, and text
    without a letter, is ``und`` with score 0. Only the text is read, whole; equal texts get equal results.
    """

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        return predict(texts, known)

    # A name that no column of the table has.
    own = "_" * max(map(len, docs.columns)) + "found"
    found = docs.withColumn(own, run.asNondeterministic()("text"))
    return found.withColumns({"lang_pred": F.col(f"{own}.lang_pred"), "score": F.col(f"{own}.score")}).drop(own)
