"""Toxicity by compression distance: toxic windows are those that a dictionary of toxic text shortens more."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORDS = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Windows whose lengths a task remembers before it starts anew.
_REMEMBERED = 200_000


@dataclass(frozen=True)
class Settings:
    """``train_rows`` bounds the labelled rows of each class that are fetched to fit the classifier, and ``train_chars``
    the length of those texts (longer ones are not used to fit). Scoring reads every text whole."""

    train_rows: int = 4000
    train_chars: int = 50_000
    dictionary_bytes: int = 65_536
    least_documents: int = 3
    surprise: float = 10.0
    strongest: int = 3
    scale: float = 0.04


@dataclass(frozen=True)
class Model:
    """The two dictionaries, and the evidence at which a text counts as toxic. No dictionary: nothing is toxic."""

    toxic: bytes
    ordinary: bytes
    threshold: float
    scale: float
    strongest: int


def windows(text: str | None) -> list[bytes]:
    """The words of a text, in lower case: runs of letters, all beyond ASCII counting as such. Null has none."""
    return _WORDS.findall((text or "").encode("utf-8", "replace").translate(_LOWER))


def _thrice(window: bytes) -> bytes:
    """A window as it is compressed, in the dictionaries too. zstandard leaves some ten bytes and less as they are."""
    return (window + b"\n") * 3


def _dictionary(counts: dict[bytes, int], size: int) -> bytes:
    """Dictionary content: the windows of the class, the most frequent last, where matches are cheapest.

    zstandard's own trainer gathers frequent substrings and drops what repeats among them. It so breaks up windows that
    share a beginning, which are what has to match here from edge to edge; so windows are kept whole.
    """
    content, left = [], size
    for window, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        left -= len(_thrice(window))
        if left < 0:
            break
        content.append(_thrice(window))
    return b"".join(reversed(content))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
        strategy=zstandard.STRATEGY_BTOPT, min_match=3, window_log=17, hash_log=17, chain_log=17, search_log=8, target_length=64)
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=settings)


def distance(model: Model) -> Callable[[bytes], float]:
    """The share of a window's length under the ordinary dictionary that the toxic one saves; remembered by window."""
    toxic, ordinary = _compressor(model.toxic).compress, _compressor(model.ordinary).compress

    @lru_cache(_REMEMBERED)
    def saved(window: bytes) -> float:
        plain = len(ordinary(_thrice(window)))
        return (plain - len(toxic(_thrice(window)))) / plain

    return saved


def evidence(text: str | None, saved: Callable[[bytes], float], strongest: int) -> float:
    """Sum over the strongest windows of a text. A single odd word is not enough; more text adds no evidence by itself."""
    found = sorted(map(saved, windows(text)), reverse=True)[:strongest]
    return float(sum(x for x in found if x > 0))


def _dictionaries(rows: list[tuple[str, int]], settings: Settings) -> Model | None:
    """A model without a threshold; None where no word marks toxic documents.

    Toxic documents are mostly ordinary text. So toxic text is taken to be the words that stand in far more toxic than
    ordinary documents, and not only inside some passage that was copied from one to the other: they need different
    words before them, at least a quarter as many as documents. Both dictionaries are as long and share the ordinary
    words, so that a window without toxic words comes out as short with one as with the other.
    """
    bad, good = (Counter(w for text, label in rows if label == k for w in set(windows(text))) for k in (1, 0))
    n_bad, n_good = (max(1, sum(label == k for _, label in rows)) for k in (1, 0))
    share = n_bad / (n_bad + n_good)

    def surprise(n: int, g: int) -> float:
        """How much likelier so uneven counts are for a word of toxic documents than for one of all, as a logarithm."""
        return n * math.log(n / (n + g) / share) + (g * math.log(g / (n + g) / (1 - share)) if g else 0.0)

    before: dict[bytes, set[bytes]] = {
        w: set() for w, n in bad.items()
        if n >= settings.least_documents and n > 9 * good[w] and surprise(n, good[w]) >= settings.surprise}
    for text, label in rows:
        found = windows(text) if label else []
        for left, w in zip([b"", *found], found):
            if w in before:
                before[w].add(left)
    marked = {w: bad[w] for w, known in before.items() if len(known) >= max(settings.least_documents, bad[w] / 4)}
    if not marked or not good:
        return None
    common, special = _dictionary(good, settings.dictionary_bytes), _dictionary(marked, settings.dictionary_bytes // 4)
    return Model(common[min(len(special), len(common) // 2):] + special, common, 0.0, settings.scale, settings.strongest)


def fit(rows: Iterable[tuple[str, int]], settings: Settings = Settings()) -> Model:
    """Fit dictionaries and threshold on (text, label) rows.

    The rows are halved by a hash of their text. Dictionaries of each half are tried on the other half, which they have
    not seen; the threshold is where the two classes' evidence there is told apart with the fewest errors. The
    dictionaries that are kept are trained on all rows.
    """
    rows = list(dict((text, int(label)) for text, label in rows if text).items())
    model = _dictionaries(rows, settings)
    if model is None:
        return Model(b"", b"", 1.0, settings.scale, settings.strongest)
    found: list[tuple[float, int]] = []
    for k in (0, 1):
        half = _dictionaries([r for r in rows if _half(r[0]) == k], settings)
        if half is not None:
            saved = distance(half)
            found += [(evidence(text, saved, settings.strongest), label) for text, label in rows if _half(text) != k]
    values, labels = np.array([e for e, _ in sorted(found)]), np.array([label for _, label in sorted(found)])
    cuts = np.unique(np.concatenate([[0.2], (values[1:] + values[:-1]) / 2])) if len(values) else np.array([0.2])
    errors = np.array([np.sum((values > c) != labels) for c in cuts])
    best = cuts[errors == errors.min()]
    return Model(model.toxic, model.ordinary, float((best[0] + best[-1]) / 2), settings.scale, settings.strongest)


def _half(text: str) -> int:
    return crc32(text.encode("utf-8", "replace")) >> 8 & 1


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), fold: int = 5) -> list[tuple[str, int]]:
    """At most ``train_rows`` labelled texts of each class, picked by a hash, none with crc32(doc_id) divisible by ``fold``.

    Documents with contradicting or null labels are not used. Only the picked rows reach the driver.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % fold != 0)).groupBy(
        "doc_id").agg(F.min("toxic").alias("low"), F.max("toxic").alias("high")).filter("low = high")
    chance = F.md5(F.col("doc_id").cast("string"))
    picked = [known.filter(F.col("low") == k).orderBy(chance).limit(settings.train_rows) for k in (0, 1)]
    few = picked[0].unionByName(picked[1]).select(F.col("doc_id").alias("l_doc_id"), F.col("low").alias("label"))
    texts = docs.select("doc_id", "text").filter(F.length("text") <= settings.train_chars).join(
        F.broadcast(few), F.col("doc_id") == F.col("l_doc_id"))
    return [(r.text, r.label) for r in sorted(texts.select("doc_id", "text", "label").collect(), key=lambda r: (
        _shuffled(r.doc_id), r.text))]


def _shuffled(doc_id: int) -> int:
    """A fixed shuffle, so that halves of the training rows do not follow the ids."""
    return (int(doc_id) * 0x9E3779B97F4A7C15) % (1 << 64)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on); all other columns stay.

    Only the text is read. Null, empty and letterless texts have no windows and score as low as any. Equal texts score
    equally; an empty table stays empty.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        saved = distance(model) if model.toxic else (lambda window: 0.0)
        x = np.array([evidence(t, saved, model.strongest) for t in texts], dtype="float64")
        return pd.Series(1 / (1 + np.exp(-np.clip((x - model.threshold) / model.scale, -500, 500))))

    # One evaluation of the text, not one per use of the score.
    scored = docs.withColumn("score", score.asNondeterministic()("text"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the documents that a classifier fitted on ``labels`` rejects; its columns and other rows unchanged."""
    named = docs.select(F.col("text"), F.struct(*docs.columns).alias("row"))
    kept = score_toxicity(named, fit(training_rows(docs, labels, settings), settings)).filter("predicted = 0")
    return kept.select("row.*")
