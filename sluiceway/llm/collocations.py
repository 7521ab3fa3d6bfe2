"""Phrase collocation mining: phrases counted in burst tries that spill, scored exactly, best of each language."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from xxhash import xxh64_intdigest

from sluiceway.llm.common import bounded, cut, hash_filter, may_hold

#: ASCII to lower case, and what ends a piece to line ends, in one pass over the bytes of a text.
_BYTES = bytes(10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else c + 32 if 65 <= c <= 90 else c for c in range(256))
_AFTER = re.compile(rb"[ \t\n]")
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Mining:
    """Phrases of 2 to ``longest`` words that occur ``least`` times; the first ``top`` of each language.

    A phrase goes where a longer one that holds it has ``percent`` of its occurrences. The other settings bound memory: a
    container bursts above ``burst`` entries; above ``entries`` entries in a task, whole subtrees are spilled, largest
    first, until half are left; above ``words`` different words, ``word_bytes`` of them or 8 times ``words`` counts of single
    words all is. ``block`` bytes of texts are split at a time. ``filter_bits`` is the logarithm of the size of the filter between two passes.
    """

    longest: int = 3
    least: int = 10
    top: int = 2000
    percent: int = 50
    burst: int = 4096
    entries: int = 800_000
    words: int = 400_000
    word_bytes: int = 16 << 20
    slots: int = 1024
    block: int = 1 << 20
    filter_bits: int = 26

    @property
    def bits(self) -> int:
        """Of a word's number: a sequence is one number of 63 bits. A block has fewer than ``block`` words, new ones included."""
        bits = 63 // self.longest
        if self.words + self.block // 2 >= 1 << bits:
            raise ValueError("words and block are too large for phrases of this length")
        return bits


class _Inner(dict):
    """A burst container: subtrees by the next word's number, and under 0 how often the path itself occurs."""


def _length(codes: np.ndarray, mining: Mining) -> np.ndarray:
    """How many words a code stands for."""
    length = np.zeros(len(codes), "int64")
    for k in range(mining.longest):
        length += codes >= np.int64(1 << mining.bits * k)
    return length


def _dealt(keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The values of each key."""
    order = np.argsort(keys.astype("uint16") if len(keys) and keys.max() < 1 << 16 else keys, kind="stable")  # 16 bits are sorted by radix
    keys, values = keys[order], values[order]
    edges = np.flatnonzero(np.diff(keys, prepend=-1)).tolist()
    for at, end in zip(edges, [*edges[1:], len(keys)]):
        yield int(keys[at]), values[at:end]


class BurstTrie:
    """Counts of word sequences: hash containers under a shallow trie of word numbers.

    At the top words share containers (by their number modulo ``slots``), whose keys are whole sequences as one number. A
    container that grows too large becomes a node with a container per next word, whose keys are what follows that word.
    How often single words occur is kept at the root, by number.
    """

    def __init__(self, mining: Mining) -> None:
        self.mining, self.slots, self.sizes, self.words = mining, {}, {}, np.zeros(1, "int64")

    def add_words(self, ids: np.ndarray) -> None:
        """Count single words; 0 is none."""
        counts = np.bincount(ids, minlength=len(self.words))
        counts[:len(self.words)] += self.words
        self.words = counts

    def add(self, codes: np.ndarray) -> None:
        """Count many sequences at once: dealt to the containers by sorting, counted in these one by one."""
        first = codes >> (_length(codes, self.mining) - 1) * self.mining.bits
        for slot, some in _dealt(first % self.mining.slots, codes):
            node = self.slots.get(slot)
            if node is None:
                node = self.slots[slot] = Counter()
            self._into(node, some)

    def _into(self, node: Counter | _Inner, codes: np.ndarray) -> None:
        if node.__class__ is not _Inner:
            node.update(codes.tolist())
            return
        node[0] += int((codes == 0).sum())
        codes = codes[codes > 0]
        shift = (_length(codes, self.mining) - 1) * self.mining.bits
        first = codes >> shift
        for word, rest in _dealt(first, codes - (first << shift)):
            child = node.get(word)
            if child is None:
                child = node[word] = Counter()
            self._into(child, rest)

    def _settle(self, node: dict, depth: int) -> tuple[dict, int]:
        """(node or what it has burst to, its entries). Codes of the burst node lose their first word."""
        if node.__class__ is not _Inner:
            if len(node) <= self.mining.burst or depth >= self.mining.longest:
                return node, len(node)
            inner, bits = _Inner({0: node.get(0, 0)}), self.mining.bits
            for code, n in node.items():
                if code:
                    shift = (code.bit_length() - 1) // bits * bits
                    child = inner.get(code >> shift)
                    if child is None:
                        child = inner[code >> shift] = Counter()
                    child[code & (1 << shift) - 1] += n
            node = inner
        size = 1
        for word, child in node.items():
            if word:
                n = len(child)
                if child.__class__ is _Inner or n > self.mining.burst:
                    node[word], n = self._settle(child, depth + 1)
                size += n
        return node, size

    def settle(self) -> int:
        """Burst what has grown too large; the number of entries in all."""
        self.sizes = {}
        for slot, node in self.slots.items():
            self.slots[slot], self.sizes[slot] = self._settle(node, 0)
        return sum(self.sizes.values())

    def take(self, leave: int) -> tuple[np.ndarray, np.ndarray]:
        """Spill subtrees, largest first, until at most ``leave`` entries are left: (sequences, counts)."""
        left = self.settle()
        paths, sizes, keys, counts = out = [], [], [], []
        for slot in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if left <= leave:
                break
            left -= self.sizes[slot]
            self._flat(self.slots.pop(slot), 0, *out)
        # Containers are small and many, so their paths are put in front of all sequences at once.
        codes, counts = np.array(keys, "int64"), np.array(counts, "int64")
        codes |= np.repeat(np.array(paths, "int64"), sizes) << _length(codes, self.mining) * self.mining.bits
        return codes[counts > 0], counts[counts > 0]

    def _flat(self, node: dict, path: int, paths: list[int], sizes: list[int], keys: list[int], counts: list[int]) -> None:
        inner = node.__class__ is _Inner
        paths.append(path)
        sizes.append(1 if inner else len(node))
        keys.extend((0,) if inner else node)
        counts.extend((node[0],) if inner else node.values())
        for word, child in node.items() if inner else ():
            if word:
                self._flat(child, path << self.mining.bits | word, paths, sizes, keys, counts)


class _Numbers(dict):
    """Words to numbers from 1, in the order they come; a full stop, which no word holds, ends a piece and has 0."""

    def __init__(self) -> None:
        super().__init__({b".": 0})
        self.bytes = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.bytes += len(word)
        return number


def _blocks(data: bytes, size: int) -> Iterator[tuple[bytes, bool]]:
    """Blocks that end behind a separator, and whether it is the last."""
    at = 0
    while at < len(data):
        cut_at = _AFTER.search(data, at + size)
        end = cut_at.end() if cut_at else len(data)
        yield data[at:end], end == len(data)
        at = end


def _tokens(data: bytes) -> tuple[np.ndarray, np.ndarray, pa.LargeBinaryArray]:
    """Where words begin and pieces end, which of these places are words, and the words."""
    raw = np.frombuffer(data, "uint8")
    inside = (raw != 32) & (raw != 9) & (raw != 10)
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begins = edges[::2]
    offsets = np.zeros(len(begins) + 1, "int64")
    np.cumsum(edges[1::2] - begins, out=offsets[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
    marks = raw == 10
    marks[begins] = True
    places = np.flatnonzero(marks)
    return places, raw[places] != 10, words


def _together(rows: Iterator[tuple[str, bytes]], size: int) -> Iterator[tuple[str, bytes]]:
    """Texts of a language joined by line ends, which end a piece as the end of a text does; at most about ``size`` bytes wait."""
    texts, total = defaultdict(list), 0
    for lang, text in rows:
        if len(text) >= size:
            yield lang, text
            continue
        texts[lang].append(text)
        total += len(text) + 1
        if total >= size:
            for of, some in texts.items():
                yield of, b"\n".join(some)
            texts, total = defaultdict(list), 0
    for of, some in texts.items():
        yield of, b"\n".join(some)


def _fold(hashes: Sequence[np.ndarray], lang: str) -> np.ndarray:
    """One hash of several words in a row, from the hashes of each."""
    out = np.full(len(hashes[0]), xxh64_intdigest(lang.encode()), "uint64")
    for h in hashes:
        out = (out ^ h) * _MIX
        out ^= out >> np.uint64(29)
    return out


class _Counter:
    """Counts of one task over all languages, in bounded memory.

    ``known`` is a filter over the phrases of ``known_size`` words that occur often enough; a sequence of that size or
    one word more is counted only if all its parts of that size may be among them.
    """

    def __init__(self, mining: Mining, shortest: int, longest: int, known: np.ndarray | None = None, known_size: int = 0) -> None:
        self.mining, self.shortest, self.longest, self.known, self.known_size = mining, shortest, longest, known, known_size
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.tries, self.seen, self.waiting, self.waits = _Numbers(), defaultdict(lambda: BurstTrie(self.mining)), Counter(), defaultdict(list), 0
        self.hashes, self.done, self.most, self.cells = np.zeros(1024, "uint64"), 1, 0, 0

    def runs(self, leave: int, forget: bool = False) -> Iterator[pa.RecordBatch]:
        """Spilled subtrees as sorted runs of (lang, phrase, n); with ``forget`` words are numbered anew afterwards."""
        self._insert()
        names = pa.array(list(self.numbers), pa.binary()).cast(pa.string())
        order = np.empty(len(names), "int64")
        order[np.asarray(pc.sort_indices(names))] = np.arange(len(names))
        bits, share = self.mining.bits, leave // max(1, len(self.tries))
        for lang, trie in self.tries.items():
            codes, counts = trie.take(share)
            if forget:
                # Words are few and come again, so they stay as long as their numbers do.
                single = np.flatnonzero(trie.words[1:]) + 1
                codes, counts = np.concatenate([codes, single]), np.concatenate([counts, trie.words[single]])
            length = _length(codes, self.mining)
            for size in range(self.shortest, self.longest + 1):
                of = codes[length == size]
                words = [(of >> np.int64(bits * (size - 1 - k))) & np.int64((1 << bits) - 1) for k in range(size)]
                ranks = np.zeros(len(of), "int64")
                for w in words:
                    ranks = ranks << np.int64(bits) | order[w]
                sorted_ = np.argsort(ranks)
                for at in range(0, len(of), 50_000):
                    some = sorted_[at:at + 50_000]
                    parts = [names.take(pa.array(w[some])) for w in words]
                    phrase = pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(some)), phrase, pa.array(counts[length == size][some])], schema=_COUNTED)
        if forget:
            if self.shortest == 1:
                yield pa.RecordBatch.from_arrays([pa.array(list(self.seen), pa.string()), pa.array([""] * len(self.seen), pa.string()),
                                                  pa.array(list(self.seen.values()), pa.int64())], schema=_COUNTED)
            self._forget()

    def count(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        """Count one text, block by block; hands out runs where memory asks for it."""
        m, pending = self.mining, b""
        for block, last in _blocks(text.translate(_BYTES), m.block):
            block = pending + block
            places, is_word, words = _tokens(block)
            # Words are looked up once a block.
            coded = words.dictionary_encode()
            numbers = np.fromiter(map(self.numbers.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False)), "int64", len(coded.dictionary))
            ids = np.zeros(len(places), "int64")
            ids[is_word] = numbers[coded.indices.to_numpy()]
            # What begins with the last words of a block is counted with the next one.
            starts = len(ids) if last else max(0, len(ids) - m.longest + 1)
            pending = block[places[starts]:] if starts < len(ids) else b""
            n = int((ids[:starts] > 0).sum())
            self.seen[lang] += n
            if self.shortest == 1 and n:
                trie = self.tries[lang]
                self.cells -= len(trie.words)
                trie.add_words(ids[:starts])
                self.cells += len(trie.words)
                self.waits += n
            for size in range(max(2, self.shortest), self.longest + 1):
                places = np.flatnonzero(self._counts(lang, ids, size)[:starts])
                code = np.zeros(len(places), "int64")
                for k in range(size):
                    code = code << np.int64(m.bits) | ids[places + k]
                if len(code):
                    self.waiting[lang].append(code)
                    self.waits += len(code)
            # Between blocks nothing refers to numbers of words, so they may change.
            if self.waits > m.entries // 4 or self._full():
                yield from self.check()

    def _counts(self, lang: str, ids: np.ndarray, size: int) -> np.ndarray:
        """Where a sequence of ``size`` words begins that is to be counted: within a piece, and with parts that pass the filter."""
        n = max(0, len(ids) - size + 1)
        good = np.ones(n, bool)
        for k in range(size):
            good &= ids[k:k + n] > 0
        if self.known is None or not n or size < self.known_size:
            return good
        h, parts = self._hashes()[ids], len(ids) - self.known_size + 1
        likely = may_hold(self.known, _fold([h[k:k + parts] for k in range(self.known_size)], lang))
        for k in range(size - self.known_size + 1):
            good &= likely[k:k + n]
        return good

    def _hashes(self) -> np.ndarray:
        """The hash of each word by its number."""
        fresh = [xxh64_intdigest(word) for word in islice(reversed(self.numbers), len(self.numbers) - self.done)]
        if self.done + len(fresh) > len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros(self.done + len(fresh), "uint64")])
        self.hashes[self.done:self.done + len(fresh)] = fresh[::-1]
        self.done += len(fresh)
        return self.hashes

    def _insert(self) -> None:
        for lang, codes in self.waiting.items():
            self.tries[lang].add(np.concatenate(codes))
        # A sequence adds one entry at most, so entries need not be counted before there may be too many.
        self.most += self.waits
        self.waiting, self.waits = defaultdict(list), 0

    def _full(self) -> bool:
        """Whether words must be numbered anew."""
        return len(self.numbers) >= self.mining.words or self.numbers.bytes > self.mining.word_bytes or self.cells > 8 * self.mining.words

    def check(self) -> Iterator[pa.RecordBatch]:
        m = self.mining
        self._insert()
        if self._full() or len(self.tries) > 64:
            yield from self.runs(0, forget=True)
        elif self.most > m.entries:
            self.most = sum(t.settle() for t in self.tries.values())
            if self.most > m.entries:
                yield from self.runs(m.entries // 2)
                self.most = m.entries // 2


_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


def _phrase_hashes(phrases: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
                out.append(_fold([np.array([xxh64_intdigest(w)], "uint64") for w in phrase.encode().split(b" ")], lang).view("int64")[0])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["h"])

    return phrases.select("lang", "phrase").mapInArrow(run, "h long")


def _count(docs: DataFrame, mining: Mining, shortest: int, longest: int, known: Broadcast | None = None) -> DataFrame:
    """The runs that the tasks' counters hand out, merged, and cut to what occurs often enough (and phrase '').

    Runs are dealt by the prefix of a phrase: language, first word, and one of 8 parts of what follows, so that a very common
    first word goes to several tasks and a sorted run stays sorted in each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(mining, shortest, longest, None if known is None else known.value, longest - 1)
        rows = ((lang, text.as_py()) for batch in batches for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")))
        for lang, text in _together(rows, mining.block):
            yield from counter.count(lang, text)
        yield from counter.runs(0, forget=True)

    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.encode("text", "UTF-8").alias("text")).filter("text <> X''")
    runs = texts.mapInArrow(run, "lang string, phrase string, n long")
    prefix = F.xxhash64("lang", F.substring_index("phrase", " ", 1), F.pmod(F.crc32("phrase"), F.lit(8)))
    dealt = runs.withColumn("prefix", F.pmod(prefix, F.lit(1 << 20)).cast("int")).repartition("prefix")
    merged = dealt.groupBy("prefix", "lang", "phrase").agg(F.sum("n").alias("n")).drop("prefix")
    return merged.filter((F.col("n") >= mining.least) | (F.col("phrase") == ""))


def phrase_counts(docs: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """(lang, phrase, n): how often each sequence of up to ``longest`` words occurs, if at least ``least`` times; phrase '' counts all words.

    A-Z are taken in lower case; the text is split at ``[.,;:!?]`` and line ends, words stand between spaces and tabs. Each
    task counts in burst tries and hands out sorted runs, which are merged per prefix.

    The first pass counts words and pairs. A longer phrase is frequent only if both its parts that are one word shorter
    are, so each further pass counts only what a filter over the frequent parts lets through. The filter has a fixed
    size; what it lets through wrongly is counted and then dropped: results are exact. Null lang is ``und``; null text is empty.
    """
    counts = cut(_count(docs, mining, 1, min(2, mining.longest)), "phrase-counts")
    for size in range(3, mining.longest + 1):
        known = hash_filter(_phrase_hashes(counts.filter(F.size(F.split("phrase", " ")) == size - 1)), mining.filter_bits)
        longer = cut(_count(docs, mining, size, size, known), "phrase-counts")
        counts = counts.unionByName(longer)
        known.unpersist()
    return counts


def _lookup(rows: DataFrame, counts: DataFrame, phrase: Column, out: str) -> DataFrame:
    """Adds the count of another phrase of the same language; all that is looked up is there."""
    found = counts.select(F.col("lang").alias("f_lang"), F.col("phrase").alias("f_phrase"), F.col("n").alias(out))
    return rows.withColumn("wanted", phrase).join(found, (F.col("lang") == F.col("f_lang")) & (F.col("wanted") == F.col("f_phrase"))).drop(
        "f_lang", "f_phrase", "wanted")


def mine_collocations(docs: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` its two parts at the cut with the lowest score, floor(1000000 a a / (l r)), the
    earlier cut in case of a tie; ``n`` counts all words of the language. Parts of a phrase occur at least as often as it
    does, so the counts from ``least`` on hold all that is looked up. Products have 38 digits.

    A language's best are found slice by slice first, so no task sorts all its phrases. Rows of equal texts count each. Other
    columns are ignored; texts without words and empty tables give no rows.
    """
    return score_phrases(phrase_counts(docs, mining), mining)


def score_phrases(counts: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """The second half of ``mine_collocations``, from the counts."""
    small = bounded(counts)
    words, size = F.col("words"), F.size("words")
    phrases = counts.filter("phrase <> ''").withColumn("words", F.split("phrase", " ")).filter(size > 1).withColumnRenamed("n", "a")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    join = lambda i, j: F.array_join(F.slice(words, i, j), " ")
    parted = _lookup(cuts, small, join(F.lit(1), F.col("k")), "l")
    parted = _lookup(parted, small, join(F.col("k") + 1, size - F.col("k")), "r")
    scored = parted.withColumn("score", F.expr("""CAST((CAST(a AS decimal(18,0)) * CAST(a AS decimal(18,0)) * CAST(1000000 AS decimal(7,0)))
        div (CAST(l AS decimal(18,0)) * CAST(r AS decimal(18,0))) AS bigint)"""))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "words")).alias("x")).select("lang", "phrase", "x.*")

    lengths = F.sequence(F.lit(2), size - 1)
    inside = F.flatten(F.transform(lengths, lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: join(i, m))))
    longer = phrases.filter(size > 2).select("lang", F.explode(F.array_distinct(inside)).alias("part"), F.col("a").alias("more"))
    most = longer.groupBy(F.col("lang").alias("p_lang"), "part").agg(F.max("more").alias("more"))
    kept = lowest.join(most, (F.col("lang") == F.col("p_lang")) & (F.col("phrase") == F.col("part")), "left").filter(
        F.col("more").isNull() | (F.col("more") * 100 < F.col("a") * mining.percent))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    sliced = kept.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    first = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*best))).filter(F.col("rank") <= mining.top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= mining.top)
    total = counts.filter("phrase = ''").select(F.col("lang").alias("n_lang"), "n")
    return ranked.join(total, F.col("lang") == F.col("n_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
