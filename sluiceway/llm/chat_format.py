"""Chat formatting at the level of tokens: segments are encoded one by one, reserved ids mark them, texts cannot pose as marks."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import cut

#: Fixed value: the pattern that the vocabulary's merges were made with.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Longer texts are encoded in parts of so many characters, so that no run of characters takes the encoder long.
PART = 8_000


@dataclass(frozen=True)
class Template:
    """Control strings, each with a reserved id above the vocabulary. ``marks`` open the turn of a role.

    The role of any other turn is written out between ``role`` and ``role_end``. ``learn`` are the roles whose texts are
    under the loss mask.
    """

    begin: str = "<s>"
    end: str = "</s>"
    marks: tuple[tuple[str, str], ...] = (("system", "[SYS]"), ("user", "[INST]"), ("assistant", "[/INST]"))
    role: str = "[ROLE]"
    role_end: str = "[/ROLE]"
    learn: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        controls = self.controls()
        for c in controls:
            if len(c) < 2 or "\\" in c or any(c[0] == other for d in controls for other in d[1:]):
                raise ValueError(f"{c!r}: a control string needs two characters, no backslash, and a first character that no other place has")
        if len(set(controls)) < len(controls):
            raise ValueError("two control strings are alike")

    def controls(self) -> list[str]:
        return [self.begin, self.end, *(mark for _, mark in self.marks), self.role, self.role_end]

    @functools.cached_property
    def _hidden(self) -> re.Pattern:
        return re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in sorted(self.controls())))

    def escape(self, text: str) -> str:
        """One backslash more behind the first character of each control string, also of those that have some already.

        A control string so never stands in the result. A first character stands nowhere else in a control string, so
        what is matched does not overlap and ``unescape`` gives back the same text.
        """
        return self._hidden.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._hidden.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


@functools.lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    """The tokenizer of a file of ranks, one per process. It knows no special tokens: all text is ordinary text."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _parts(text: str) -> Iterator[str]:
    """The text in parts of at most ``PART`` characters, cut before a space or line end where there is one."""
    at = 0
    while len(text) - at > PART:
        end = max(text.rfind(" ", at + 1, at + PART), text.rfind("\n", at + 1, at + PART))
        end = end if end > at else at + PART
        yield text[at:end]
        at = end
    yield text[at:]


def encode_text(text: str, path: str) -> list[int]:
    encoder = encoding(path)
    return [i for part in _parts(text) for i in encoder.encode_ordinary(part)] if text else []


def assemble(role: str, text: str, template: Template, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of one turn: its mark, its text and its end, spliced from segments that were encoded separately.

    The mask is the running sum of +1 where a text to learn begins and -1 behind it.
    """
    first = encoding(path).n_vocab
    reserved = {c: first + k for k, c in enumerate(template.controls())}
    mark = dict(template.marks).get(role)
    opening = [reserved[mark]] if mark else [reserved[template.role], *encode_text(template.escape(role), path), reserved[template.role_end]]
    body = encode_text(template.escape(text), path)
    ids = np.array([*opening, *body, reserved[template.end]], dtype="int32")
    steps = np.zeros(len(ids) + 1, dtype="int8")
    if role in template.learn:
        steps[len(opening)] += 1
        steps[len(opening) + len(body)] -= 1
    return ids, np.cumsum(steps[:-1], dtype="int8")


_PIECE = "conv_id long, turn long, tie string, n_tokens long, input_ids array<int>, loss_mask array<tinyint>"


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts) if parts else [], kind))


def _encoded(rows: DataFrame, template: Template, path: str) -> DataFrame:
    """One piece per row, encoded where the row lies; only ids are moved afterwards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                few = batch.slice(at, 256)
                done = [assemble(r, t, template, path) for r, t in zip(few.column("role").to_pylist(), few.column("text").to_pylist())]
                ids, masks = [d[0] for d in done], [d[1] for d in done]
                yield pa.RecordBatch.from_arrays(
                    [few.column("conv_id"), few.column("turn"), few.column("tie"), pa.array([len(i) for i in ids], pa.int64()),
                     _lists(ids, pa.int32()), _lists(masks, pa.int8())],
                    names=["conv_id", "turn", "tie", "n_tokens", "input_ids", "loss_mask"])

    return rows.mapInArrow(run, _PIECE)


def format_chat(conversations: DataFrame, template: Template = Template(), tokenizer: str = TOKENIZER, slice_turns: int = 1024) -> DataFrame:
    """One piece per turn: conv_id, turn, ``start`` (of its tokens in the conversation), input_ids, loss_mask.

    A conversation is its pieces in the order of ``start``, without a gap; its first piece begins with the template's
    begin. Every row of ``conversations`` (conv_id, turn, role, text; other columns are ignored) is one turn: by turn, null
    first, and by a digest of role and text where turns are equal, repeated rows being turns of their own. Null text and
    null role are empty. Null conv_id is a conversation too. An empty table gives no rows.

    ``start`` is a prefix sum at two levels: pieces within slices of ``slice_turns`` turn numbers, and slices within the
    conversation. So a conversation of very many turns is spread over as many tasks as it has slices.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    keyed = rows.withColumn("tie", F.md5(F.concat("role", F.lit("\n"), "text")))
    pieces = cut(_encoded(keyed, template, tokenizer), "chat-pieces").withColumn("slice", F.floor(F.col("turn") / slice_turns))
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.groupBy("conv_id", "slice").agg(F.sum("n_tokens").alias("tokens")).select(
        F.col("conv_id").alias("o_conv"), F.col("slice").alias("o_slice"), F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("conv_id", "slice").orderBy("turn", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(
        offsets, F.col("conv_id").eqNullSafe(F.col("o_conv")) & F.col("slice").eqNullSafe(F.col("o_slice")))
    first, begin = (F.col("offset") + F.col("before")) == 0, encoding(tokenizer).n_vocab

    def opened(column: str, value: Column) -> Column:
        return F.when(first, F.concat(F.array(value), column)).otherwise(F.col(column)).alias(column)

    return placed.select("conv_id", "turn", F.when(first, 0).otherwise(F.col("offset") + F.col("before") + 1).cast("long").alias("start"),
                         opened("input_ids", F.lit(begin).cast("int")), opened("loss_mask", F.lit(0).cast("tinyint")))


def read_turn(ids: np.ndarray, mask: np.ndarray, template: Template, path: str) -> tuple[str, str, str, int]:
    """(role, text, text under the mask, characters as formatted) of a piece, from its ids alone."""
    encoder, controls, roles = encoding(path), template.controls(), {mark: role for role, mark in template.marks}
    first, role, written, body, spoken = encoder.n_vocab, None, 0, "", ""
    edges = [int(i) for i in np.flatnonzero(ids >= first)]
    for k, at in enumerate(edges):
        control = controls[int(ids[at]) - first]
        until = edges[k + 1] if k + 1 < len(edges) else len(ids)
        segment, learnt = ids[at + 1:until], mask[at + 1:until] == 1
        text = encoder.decode_bytes(segment.tolist()).decode()
        written += len(control) + len(text)
        if control == template.role:
            role = template.unescape(text)
        elif control in roles or control == template.role_end:
            role, body = roles.get(control, role), template.unescape(text)
            spoken += template.unescape(encoder.decode_bytes(segment[learnt].tolist()).decode())
    return role or "", body, spoken, written


def read_back(pieces: DataFrame, template: Template = Template(), tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per conversation, from its formatted pieces alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Pieces are sorted within their partitions and pass by one at a time: what is kept of a conversation is two digests and
    three numbers, however long it is. (SHA-256 is a chain, so the digest of one conversation is one task's work.)
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now, turns, said, counts = [], (False, None), sha256(), sha256(), [0, 0, 0]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        out = lambda rows: pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=schema)
        schema = pa.schema([pa.field(n, pa.string() if n.endswith("256") else pa.int64()) for n in names])
        for batch in batches:
            ids, masks = batch.column("input_ids"), batch.column("loss_mask")
            for k, conv in enumerate(batch.column("conv_id").to_pylist()):
                if now != (True, conv):
                    if now[0]:
                        done.append((now[1], counts[0], turns.hexdigest(), counts[1], said.hexdigest(), counts[2]))
                    now, turns, said, counts = (True, conv), sha256(), sha256(), [0, 0, 0]
                role, text, spoken, written = read_turn(ids[k].values.to_numpy(zero_copy_only=False), masks[k].values.to_numpy(zero_copy_only=False), template, tokenizer)
                turns.update(f"{role}\n{text}\n".encode())
                said.update(spoken.encode())
                counts = [counts[0] + 1, counts[1] + len(spoken), counts[2] + written]
            if len(done) >= 10_000:
                yield out(done)
                done = []
        if now[0]:
            done.append((now[1], counts[0], turns.hexdigest(), counts[1], said.hexdigest(), counts[2]))
        if done:
            yield out(done)

    ordered = pieces.select("conv_id", "start", "input_ids", "loss_mask").repartition("conv_id").sortWithinPartitions("conv_id", "start")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1: two turns whose texts are made of control strings."""
    text = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
