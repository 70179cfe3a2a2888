"""Chat formatting by token-level assembly.

Every role and text is a segment that is encoded by itself; reserved ids, which no encoder
returns, are spliced between segments, so content cannot become control.  Control strings that
occur inside a segment are escaped first, so the rendered string is safe and reversible as well.
The loss mask is a running sum over +1 where an assistant text begins and -1 where it ends.

Turns are sorted in ranges of (conversation, turn): a conversation of any size is dealt over
several tasks and comes out as several parts.  Most conversations lie whole in one part and are
digested there; of the others only their text is shuffled, in order, part by part.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.bpe import _codec
from kestrel.llm.common import batch_of

#: Most tokens of a part (one turn of any length is never cut) and of the rows a task holds before it hands them on.
PART_TOKENS, HELD_TOKENS = 1 << 16, 1 << 19

ESCAPE = "\\"


class Template:
    """Control strings of a chat template: ``turn role text_mark text end`` for each turn.

    ``others`` are control strings of other templates, which are escaped as well.  Reserved ids
    are ``first_id``, + 1 and + 2.  No control string may hold the escape character, occur in
    another or overlap another's end, so that escaping is reversible; otherwise ValueError.
    """

    def __init__(self, first_id: int, turn: str = "<|turn|>", text: str = "<|text|>", end: str = "<|end|>",
                 others: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"),
                 trained_role: str = "assistant"):
        self.first_id, self.marks, self.trained_role = first_id, (turn, text, end), trained_role
        controls = [turn, text, end, *others]
        for a in controls:
            if len(a) < 2 or ESCAPE in a or controls.count(a) > 1:
                raise ValueError(f"{a!r} cannot be a control string")
            for b in controls:
                if any(a[k:].startswith(b) or b.startswith(a[k:]) for k in range(1, len(a))):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")
        mark = re.escape(ESCAPE)
        self.bare = re.compile("|".join(f"{re.escape(c[0])}{mark}*{re.escape(c[1:])}" for c in controls))
        self.escaped = re.compile("|".join(f"{re.escape(c[0])}{mark}+{re.escape(c[1:])}" for c in controls))

    def escape(self, text: str) -> str:
        """One escape character more after the first character of every control string, escaped ones included."""
        return self.bare.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)

    def unescape(self, text: str) -> str:
        """The inverse of ``escape``."""
        return self.escaped.sub(lambda m: m[0][0] + m[0][2:], text)

    def render(self, turns) -> str:
        """The formatted string of (role, text) pairs."""
        turn, text, end = self.marks
        return "".join(f"{turn}{self.escape(r)}{text}{self.escape(t)}{end}" for r, t in turns)

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) pairs of a formatted string."""
        turn, text, end = map(re.escape, self.marks)
        return [tuple(map(self.unescape, x)) for x in re.findall(f"{turn}(.*?){text}(.*?){end}", formatted, re.DOTALL)]


# Assembly ------------------------------------------------------------------------------

class _Parts:
    """Parts of sorted turns: ``conv_id, part, whole, n_turns, ids, mask``.

    ``whole`` says that the part holds all of its conversation; a task cannot know it of the
    first and the last conversation of its range, which are never marked.
    """

    SCHEMA = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_()), ("n_turns", pa.int64()),
                        ("ids", pa.list_(pa.int32())), ("mask", pa.list_(pa.int8()))])

    def __init__(self, task: int):
        self.part, self.ready, self.size = task << 32, [], 0
        self.key, self.first, self.cut = None, True, False   # first: of the task's range; cut: has earlier parts
        self.turns: list[np.ndarray] = []
        self.trained: list[tuple[int, int]] = []
        self.tokens = 0

    def add(self, key, ids: np.ndarray, trained: tuple[int, int] | None):
        if self.turns and key != self.key:
            self.close(whole=not self.first and not self.cut)
            self.first = self.cut = False
        elif self.turns and self.tokens + len(ids) > PART_TOKENS:
            self.close(whole=False)
            self.cut = True
        self.key = key
        if trained:
            self.trained.append((self.tokens + trained[0], self.tokens + trained[1]))
        self.turns.append(ids)
        self.tokens += len(ids)

    def close(self, whole: bool):
        if not self.turns:
            return
        steps = np.zeros(self.tokens + 1, np.int8)
        for start, stop in self.trained:
            steps[start] += 1
            steps[stop] -= 1
        self.ready.append((self.key, self.part, whole, len(self.turns), np.concatenate(self.turns), np.cumsum(steps[:-1], dtype=np.int8)))
        self.size += self.tokens
        self.part += 1
        self.turns, self.trained, self.tokens = [], [], 0

    def flush(self) -> pa.RecordBatch:
        keys, parts, whole, turns, ids, masks = zip(*self.ready)
        ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
        self.ready, self.size = [], 0
        return batch_of(self.SCHEMA, [list(keys), list(parts), list(whole), list(turns),
                                      pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids), pa.int32())),
                                      pa.ListArray.from_arrays(ends, pa.array(np.concatenate(masks), pa.int8()))])


def _assemble(batches, shared, template: Template):
    encode, _ = _codec(shared)
    turn, text_mark, end = (np.array([template.first_id + k], np.int32) for k in range(3))
    parts = _Parts(TaskContext.get().partitionId())
    for b in batches:
        for key, role, text in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            role = role.as_py()
            head, body = (np.frombuffer(encode(template.escape(x)), "<u4").astype(np.int32) for x in (role, text.as_py()))
            at = len(head) + 2
            parts.add(key, np.concatenate([turn, head, text_mark, body, end]),
                      (at, at + len(body)) if role == template.trained_role else None)
            if parts.size > HELD_TOKENS:
                yield parts.flush()
    parts.close(whole=False)
    if parts.ready:
        yield parts.flush()


def format_conversations(rows: DataFrame, shared, template: Template, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, part, whole, n_turns, ids, mask``: formatted token ids and loss mask of every conversation, in parts.

    A conversation's parts in the order of ``part`` are its token sequence; turns are never
    cut.  Turns are ordered by ``turn`` (null first), equal ones by role, then by a hash of the
    text, then by text; repeated rows are turns of their own.  A null role or text counts as
    empty; rows with a null id are one conversation without id.  An empty table gives an empty
    result; other columns are ignored, whatever their names.  ``shared`` is ``bpe.tokenizer``'s.
    """
    src = rows.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                      *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))))
    order = ["conv_id", "turn", "role", F.xxhash64("text")]
    ordered = src.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(
        lambda it: _assemble(it, shared, template), "conv_id long, part long, whole boolean, n_turns long, ids array<int>, mask array<byte>")


# Reading back --------------------------------------------------------------------------

def read_turns(ids: np.ndarray, mask: np.ndarray, decode, template: Template):
    """``(role, text, learnt, chars)`` of every turn: the unescaped strings, the text under the mask and the formatted length.

    Ids that are no sequence of whole turns raise ValueError.
    """
    marks = np.flatnonzero(ids >= template.first_id)
    kinds = ids[marks] - template.first_id
    if len(marks) % 3 or not np.array_equal(kinds, np.tile(np.arange(3), len(marks) // 3)) or (len(ids) and (marks[0] != 0 or marks[-1] != len(ids) - 1)):
        raise ValueError("not a sequence of whole turns")
    fixed = sum(map(len, template.marks))
    packed = ids.astype("<u4")
    for a, b, c in marks.reshape(-1, 3).tolist():
        role, text = (decode(packed[x + 1:y].tobytes()).decode("utf-8") for x, y in ((a, b), (b, c)))
        under = mask[a:c + 1].astype(bool)
        under[[0, b - a, c - a]] = False  # reserved ids are no text
        learnt = decode(packed[a:c + 1][under].tobytes()).decode("utf-8") if under.any() else ""
        yield template.unescape(role), template.unescape(text), template.unescape(learnt), fixed + len(role) + len(text)


class _Digest:
    """Running digests of one conversation's turns."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted = 0

    def add(self, n_turns: int, turns: bytes, loss_chars: int, loss: bytes, formatted: int):
        self.turns.update(turns)
        self.loss.update(loss)
        self.n_turns += n_turns
        self.loss_chars += loss_chars
        self.formatted += formatted


# A whole conversation's row has digests, another part's row the bytes they are made from.
PART = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()), ("loss_chars", pa.int64()), ("formatted_chars", pa.int64()),
                  ("turns_sha256", pa.string()), ("loss_sha256", pa.string()), ("turns", pa.binary()), ("loss", pa.binary())])


def _read_parts(batches, shared, template: Template):
    _, decode = _codec(shared)
    for b in batches:
        key, part, whole, ids, mask = (b.column(b.schema.get_field_index(k)) for k in ("conv_id", "part", "whole", "ids", "mask"))
        out = []
        for i in range(b.num_rows):
            turns, loss, formatted, loss_chars, n = [], [], 0, 0, 0
            for role, text, learnt, chars in read_turns(ids[i].values.to_numpy(), mask[i].values.to_numpy(), decode, template):
                turns.append(f"{role}\n{text}\n".encode())
                loss.append(learnt.encode())
                n, formatted, loss_chars = n + 1, formatted + chars, loss_chars + len(learnt)
            turns, loss = b"".join(turns), b"".join(loss)
            row = dict(conv_id=key[i].as_py(), part=part[i].as_py(), n_turns=n, loss_chars=loss_chars, formatted_chars=formatted)
            if whole[i].as_py():
                row |= dict(turns_sha256=hashlib.sha256(turns).hexdigest(), loss_sha256=hashlib.sha256(loss).hexdigest())
            else:
                row |= dict(turns=turns, loss=loss)
            out.append(row)
        yield pa.RecordBatch.from_pylist(out, schema=PART)


def _join_parts(batches):
    """One row per conversation from its parts in order; holds one part at a time."""
    schema = pa.schema([f for f in PART if f.name in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")])

    def row(key, d: _Digest):
        return dict(conv_id=key, n_turns=d.n_turns, turns_sha256=d.turns.hexdigest(), loss_chars=d.loss_chars,
                    loss_sha256=d.loss.hexdigest(), formatted_chars=d.formatted)

    key, digest = None, None
    for b in batches:
        columns = {f.name: b.column(i) for i, f in enumerate(b.schema)}
        out = []
        for i in range(b.num_rows):
            r = {k: c[i].as_py() for k, c in columns.items()}
            if digest is not None and (r["conv_id"] != key or r["turns"] is None):
                out.append(row(key, digest))
                digest = None
            if r["turns"] is None:
                out.append({f.name: r[f.name] for f in schema})
                continue
            key, digest = r["conv_id"], digest or _Digest()
            digest.add(r["n_turns"], r["turns"], r["loss_chars"], r["loss"], r["formatted_chars"])
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if digest is not None:
        yield pa.RecordBatch.from_pylist([row(key, digest)], schema=schema)


def read_back(formatted: DataFrame, shared, template: Template) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of each conversation, from ``format_conversations``' rows.

    ``turns_sha256`` is of role, newline, text, newline per turn, ``loss_*`` of the text under the
    mask, unescaped; ``formatted_chars`` counts the code points of the rendered string.
    """
    fields = "conv_id long, part long, n_turns long, loss_chars long, formatted_chars long, turns_sha256 string, loss_sha256 string, turns binary, loss binary"
    parts = formatted.mapInArrow(lambda it: _read_parts(it, shared, template), fields)
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.mapInArrow(_join_parts, "conv_id long, n_turns long, loss_chars long, formatted_chars long, turns_sha256 string, loss_sha256 string")


# Query ---------------------------------------------------------------------------------

# 23 characters of control strings a turn; each control string within a segment gets one more.
SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS body FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
    SELECT *, length(role) + length(body) + 23 + len(regexp_extract_all(role || chr(10) || body,
        '<\\*(?:\|(?:turn|text|end|im_start|im_end|endoftext)\|>|/?s>|</?SYS>>)|\[\\*/?INST\]')) AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn NULLS FIRST, role)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(body) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(body, '' ORDER BY turn NULLS FIRST) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
