"""Conversations as token sequences with a loss mask (operator 11).

**Assembly.** A turn is an opening id, the ids of its text, and a closing id; the text
is encoded on its own, so no token crosses a mark, and the marks are reserved ids above
the vocabulary. Turns are encoded row by row, before anything is shuffled. Then rows go
to their conversation in order; the first gets the id of ``<s>``, and running sums over
the flat ids of a batch give each turn's first position and the loss mask: 1 from the
token after an answer's opening id up to its closing id, which stays outside.

=========  ==========================
role       form
=========  ==========================
user       ``[INST]text[/INST]``
system     ``[SYS]text[/SYS]``
assistant  ``[ANS]text</s>``
any other  ``[ROLE]role[/ROLE]text[/TURN]``
=========  ==========================

**Escapes.** Every control string begins with ``<`` or ``[`` and holds neither after
it. Where a text has one, with any number of backslashes after its first character, it
gets a backslash more; reading back takes one away. So no text holds a control string,
and the rendered form can be parsed without the ids too.

**Reading back** works on the ids and the mask alone: marks delimit conversations and
turns, tokens become bytes by a table. A digest of a whole conversation is one stream
by its nature: a conversation's turns pass one task in order, a batch at a time,
whatever their number; nothing of it is held but the running digest.

The vocabulary is a byte-level BPE read from a path on the driver and sent to the
tasks. A text of more than ``SEGMENT`` characters, or with more than ``BLANKS`` of white
space in a row, is encoded in pieces.

Defined cases: a null text or role counts as empty; rows go by turn (null first), ties
by role and then by their ids; repeated rows are turns of their own; a null
conversation id is a conversation; extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The control strings, in the order of their ids.
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ANS]", "[ROLE]", "[/ROLE]", "[/TURN]"]
OPEN = {"user": "[INST]", "system": "[SYS]", "assistant": "[ANS]"}
CLOSE = {"[INST]": "[/INST]", "[SYS]": "[/SYS]", "[ANS]": "</s>", "[ROLE]": "[/TURN]"}
SEGMENT = 1 << 20
BLANKS = 1000
_BLANKS = re.compile(rf"\s{{{BLANKS}}}")


class ChatVocabulary:
    """A byte-level BPE vocabulary with reserved ids for the marks above it."""

    def __init__(self, path: str, pattern: str):
        """``path``: a file of tokens in base 64 and their ranks; ``pattern`` splits text
        before the merges."""
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.pattern = pattern
        ids = {i: token for token, i in self.ranks.items()}
        first = max(ids) + 1
        self.mark = {m: first + k for k, m in enumerate(MARKS)}
        self.first, self.size = first, first + len(MARKS)
        if self.size > 1 << 16:
            raise ValueError("the vocabulary and the marks must fit 16-bit ids")
        rendered = ids | {i: m.encode() for m, i in self.mark.items()}
        parts = [rendered.get(i, b"") for i in range(self.size)]
        self.table = np.frombuffer(b"".join(parts), np.uint8)
        self.at = np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int64)
        #: code points that begin in each token's bytes
        self.points = np.array([sum(b & 0xC0 != 0x80 for b in p) for p in parts], np.int64)
        body = "|".join(re.escape(c[1:]) for c in [*MARKS, "<|endoftext|>"])
        self.escapes = re.compile(rf"([<\[])(?=\\*(?:{body}))")
        self.unescapes = re.compile(rf"([<\[])\\(?=\\*(?:{body}))")
        self._encoder = None

    def __getstate__(self):
        return self.__dict__ | {"_encoder": None}

    def escape(self, text: str) -> str:
        return self.escapes.sub(r"\1\\", text)

    def unescape(self, text: str) -> str:
        return self.unescapes.sub(r"\1", text) if "\\" in text else text

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, escaped."""
        if self._encoder is None:
            self._encoder = tiktoken.Encoding("chat", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})
        return [np.concatenate([np.array(self._encoder.encode_ordinary(p), np.uint16) for p in _pieces(self.escape(t))]) for t in texts]

    def bytes_of(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of a run of ids, and where each id's begin."""
        n = self.at[ids + 1] - self.at[ids]
        off = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(n, out=off[1:])
        return self.table[np.arange(off[-1]) + np.repeat(self.at[ids] - off[:-1], n)].tobytes(), off

    def turn(self, role: str, ids: dict[str, np.ndarray], text: np.ndarray) -> list[np.ndarray]:
        """The ids of a turn: ``ids`` has those of roles without a form of their own."""
        mark = lambda m: np.array([self.mark[m]], np.uint16)
        start = OPEN.get(role, "[ROLE]")
        named = [ids[role], mark("[/ROLE]")] if start == "[ROLE]" else []
        return [mark(start), *named, text, mark(CLOSE[start])]


def _pieces(text: str) -> list[str]:
    """A text as it is encoded: cut every ``SEGMENT`` characters and after every ``BLANKS``
    of white space in a row, which the pattern could not get past otherwise."""
    cuts = sorted({*range(0, len(text), SEGMENT), *(m.end() for m in _BLANKS.finditer(text))} | {0, len(text)})
    return [text[a:b] for a, b in zip(cuts, cuts[1:])] or [""]


def _slices(texts: list[str], limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    i = total = 0
    for k, t in enumerate(texts):
        if total and total + len(t) > limit:
            yield i, k
            i, total = k, 0
        total += len(t)
    if texts:
        yield i, len(texts)


def _encoded(rows: DataFrame, vocabulary) -> DataFrame:
    """(conv, turn, role, ids) of rows (conv, turn, role, text); ids as 16-bit numbers."""
    schema = T.StructType([*(rows.schema[c] for c in ("conv", "turn", "role")), T.StructField("ids", T.BinaryType())])

    def run(batches):
        v = vocabulary.value
        for batch in batches:
            roles = batch.column("role").to_pylist()
            texts = batch.column("text").to_pylist()
            for i, j in _slices(texts):
                other = sorted({r for r in roles[i:j] if r not in OPEN})
                named = dict(zip(other, v.encode(other))) if other else {}
                ids = [np.concatenate(v.turn(r, named, t)).astype("<u2").tobytes() for r, t in zip(roles[i:j], v.encode(texts[i:j]))]
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("conv", "turn", "role")), pa.array(ids, pa.binary())],
                                                 names=schema.names)

    return rows.mapInArrow(run, schema)


def _changes(conv: list, last: list) -> np.ndarray:
    """Whether each row begins a conversation; ``last`` holds the one before, if any."""
    before = [*last, *conv][-len(conv) - 1:-1] if last else [object(), *conv[:-1]]
    return np.array([a != b for a, b in zip(conv, before)], bool)


def format_chat(table: DataFrame, vocabulary: ChatVocabulary, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row per turn, in partitions that hold whole conversations in order: conv, turn,
    place (0, 1, ... in the conversation), start (its first token's position there),
    ids, mask (one per id)."""
    held = table.sparkSession.sparkContext.broadcast(vocabulary)
    none = F.lit("")
    rows = table.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), none).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), none).alias("text"))
    ordered = _encoded(rows, held).repartition("conv").sortWithinPartitions("conv", "turn", "role", "ids")
    schema = T.StructType([rows.schema["conv"], rows.schema["turn"], T.StructField("place", T.LongType()),
                           T.StructField("start", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("mask", T.ArrayType(T.ByteType()))])

    def run(batches):
        mark = held.value.mark
        last, place0, start0 = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv").to_pylist()
            first = _changes(conv, last)
            raw = [np.frombuffer(b, "<u2") for b in batch.column("ids").to_pylist()]
            size = np.array([len(r) for r in raw]) + first
            off = np.r_[0, np.cumsum(size)]
            flat = np.empty(off[-1], np.int32)
            fill = np.ones(off[-1], bool)
            fill[off[:-1][first]] = False
            flat[~fill] = mark["<s>"]
            flat[fill] = np.concatenate(raw)
            # the conversation's first row in this batch: what came before counts from there
            head = np.maximum.accumulate(np.where(first, np.arange(len(conv)), -1))
            place = np.where(head < 0, place0 + np.arange(len(conv)), np.arange(len(conv)) - head)
            start = np.where(head < 0, start0 + off[:-1], off[:-1] - off[np.maximum(head, 0)])
            opens = flat == mark["[ANS]"]
            mask = (np.cumsum(opens.astype(np.int64) - (flat == mark["</s>"])) > 0) & ~opens
            last, place0, start0 = [conv[-1]], int(place[-1]) + 1, int(start[-1] + size[-1])
            offsets = pa.array(off.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("turn"), pa.array(place), pa.array(start),
                 pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.ListArray.from_arrays(offsets, pa.array(mask.astype(np.int8)))],
                names=schema.names)

    return ordered.mapInArrow(run, schema)


class _Reading:
    """What is known so far of the conversation in hand."""

    def __init__(self, conv):
        self.conv, self.n, self.loss, self.points = conv, 0, 0, 0
        self.turns, self.under = hashlib.sha256(), hashlib.sha256()

    def row(self):
        return (self.conv, self.n, self.turns.hexdigest(), self.loss, self.under.hexdigest(), self.points)


def read_back(formatted: DataFrame, vocabulary: ChatVocabulary, in_order: bool = False) -> DataFrame:
    """conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of what
    :func:`format_chat` returned. ``in_order``: it has not been through a table since."""
    held = formatted.sparkSession.sparkContext.broadcast(vocabulary)
    rows = formatted.select("conv", "place", "ids", "mask")
    if not in_order:
        rows = rows.repartition("conv").sortWithinPartitions("conv", "place")
    schema = T.StructType([formatted.schema["conv"], T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                           T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
                           T.StructField("formatted_chars", T.LongType())])
    roles = {OPEN[r]: r for r in OPEN}

    def rows_of(done, kind):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in done], kind), *(pa.array([r[k] for r in done]) for k in range(1, 6))],
                                          names=schema.names)

    def run(batches):
        v = held.value
        name = {i: m for m, i in v.mark.items()}
        now = None
        for batch in batches:
            type_, done = batch.schema.field("conv").type, []
            conv = batch.column("conv").to_pylist()
            lists = batch.column("ids")
            flat = lists.flatten().to_numpy()
            mask = batch.column("mask").flatten().to_numpy().astype(bool)
            row = np.repeat(np.arange(len(conv)), lists.value_lengths().to_numpy())
            raw, at = v.bytes_of(flat)
            points = np.r_[0, np.cumsum(v.points[flat])]
            where = np.flatnonzero(flat >= v.first)
            text = lambda a, b: v.unescape(raw[at[a]:at[b]].decode())
            role, begun, counted = "", 0, 0
            for k, kind in zip(where.tolist(), flat[where].tolist()):
                kind = name[kind]
                if kind == "<s>":
                    if now:
                        now.points += int(points[k] - points[counted])
                        done.append(now.row())
                    now, counted = _Reading(conv[row[k]]), k
                elif kind in CLOSE:
                    role, begun = roles.get(kind, ""), k + 1
                elif kind == "[/ROLE]":
                    role, begun = text(begun, k), k + 1
                else:
                    said = text(begun, k)
                    now.n += 1
                    now.turns.update(f"{role}\n{said}\n".encode())
                    kept = mask[begun:k]
                    if kept.any():
                        # the mask's runs are whole texts: unescaped one by one
                        edge = np.flatnonzero(np.diff(np.r_[0, kept.astype(np.int8), 0])) + begun
                        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                            under = text(a, b)
                            now.loss += len(under)
                            now.under.update(under.encode())
            if now and len(flat):
                now.points += int(points[-1] - points[counted])
            if done:
                yield rows_of(done, type_)
        if now:
            yield rows_of([now.row()], type_)

    return rows.mapInArrow(run, schema)


#: The digests straight from the table; formatted_chars from the template and the
#: number of control strings in the texts.
ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) t(k)),
e AS (SELECT *, len(regexp_extract_all(text || chr(10) || CASE WHEN role IN ('user', 'system', 'assistant') THEN '' ELSE role END,
    '[<\[]\\*(s>|/s>|/?INST\]|/?SYS\]|ANS\]|/?ROLE\]|/TURN\]|\|endoftext\|>)')) AS escapes,
  CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 9 ELSE 20 + length(role) END AS marks FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(length(text) + escapes + marks))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
