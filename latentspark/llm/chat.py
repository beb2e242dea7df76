r"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as one text, turn after turn: a user's is ``[INST]..[/INST]``, an assistant's
``<s>..</s>``, any other ``[TURN]role[TEXT]..[/TURN]``. Control strings, and names of the tokenizer's special
tokens, inside roles and texts get a backslash after their first character (one more, if some stand there),
which reading takes out again; so a text never looks like a mark of a turn, and any text comes back as it was.

The rendered text is encoded once; offsets are running sums of the tokens' bytes. Control strings are tokens of their own, so no token holds
part of a text and part of a mark. The spans of the texts to learn and the spans of tokens are both sorted; a
binary search finds for each token the first span that ends after it begins, and the mask is whether the two
intersect.

Rows are brought in order by ranges of conversation, turn and ties, so a conversation of very many turns spreads
over several tasks. A row of the result is a piece: all of a conversation, or, if it is longer than
``PIECE_CHARS`` or lies at a border of ranges, some turns of it; pieces are numbered in order. Reading back
digests whole conversations where they are; only the others are brought together, and pass through a running
digest piece by piece.

Rows without a role or text have empty ones; a null turn comes first; equal turns are ordered by role, then by
hash of the text, then text; repeated rows are turns of their own. Rows with a null conversation are one conversation. An
empty text gives no tokens. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latentspark.llm.byte_level import ByteLevel
from latentspark.session import cut_lineage

# Control strings of the template, a fixed value: where a turn of the role begins and ends.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
TURN, TEXT, END = "[TURN]", "[TEXT]", "[/TURN]"
PIECE_CHARS = 1 << 20
_BATCH_CHARS = 1 << 21


class Template:
    """Renders turns, and reads them again; ``special`` are further strings that texts may not hold unescaped."""

    def __init__(self, special: tuple[str, ...] = ()):
        self.controls = [mark for pair in MARKS.values() for mark in pair] + [TURN, TEXT, END]
        guarded = sorted({*self.controls, *special}, key=lambda c: (-len(c), c))
        firsts = {c[0] for c in guarded}
        if any(f in c[1:] for f in firsts for c in guarded) or "\\" in firsts:
            raise ValueError("a control string begins inside another")
        found = "|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in guarded)
        self._guarded = re.compile(found)
        marks = "|".join(map(re.escape, self.controls))
        self._marks = re.compile(f"({marks})")
        self._roles = {begin: role for role, (begin, _) in MARKS.items()}

    def escape(self, text: str) -> str:
        return self._guarded.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._guarded.sub(lambda m: m[0][0] + m[0][2:], text)

    def render(self, role: str, text: str) -> tuple[str, str, str]:
        """What stands before the text, the text, and what follows."""
        if role in MARKS:
            return MARKS[role][0], self.escape(text), MARKS[role][1]
        return f"{TURN}{self.escape(role)}{TEXT}", self.escape(text), END

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Roles and texts of a rendered conversation."""
        parts, role, text = self._marks.split(formatted), None, ""
        for part in parts:
            if part in self._roles:
                role, text = self._roles[part], ""
            elif part == TURN:
                role, text = None, ""
            elif part == TEXT:
                role, text = text, ""
            elif part in (END, *(end for _, end in MARKS.values())):
                yield self.unescape(role), self.unescape(text)
            else:
                text = part


def masked(starts: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which tokens ``starts..ends`` meet a span ``first..last``; both are sorted and spans do not overlap."""
    if not len(first):
        return np.zeros(len(starts), bool)
    at = np.searchsorted(last, starts, side="right")
    return (at < len(first)) & (first[np.minimum(at, len(first) - 1)] < ends)


_PIECES = ("conv_id bigint, piece bigint, whole boolean, n_turns bigint, formatted string, ids array<int>, "
           "ends array<int>, loss array<boolean>")


class Formatter:
    def __init__(self, tokenizer_json: str, learn: tuple[str, ...]):
        marks = Template().controls
        self.tokenizer, self.learn = ByteLevel(tokenizer_json, tuple(marks)), learn
        self.template = Template(self.tokenizer.special)

    def piece(self, turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
        """Rendered turns, and the bytes where the texts to learn begin and end."""
        parts, first, last, at = [], [], [], 0
        for role, text in turns:
            before, body, after = self.template.render(role, text)
            parts += (before, body, after)
            before, body, after = (len(x.encode()) for x in (before, body, after))
            if role in self.learn and body:
                first.append(at + before)
                last.append(at + before + body)
            at += before + body + after
        return "".join(parts), first, last

    def encoded(self, pieces: list[tuple]) -> pa.RecordBatch:
        """Rows of ``(conv_id, piece, whole, turns)``."""
        made = [self.piece(turns) for *_, turns in pieces]
        ids = [np.frombuffer(x, np.uint32) for x in self.tokenizer.ids([text for text, _, _ in made])]
        ends, loss = [], []
        for one, (_, first, last) in zip(ids, made):
            to = np.cumsum(self.tokenizer.pieces.length[one])
            ends.append(to)
            loss.append(masked(np.concatenate(([0], to[:-1])), to, np.array(first, np.int64), np.array(last, np.int64)))
        begins = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(begins), pa.array(np.concatenate(x).astype(kind))) for x, kind in (
            (ids, np.int32), (ends, np.int32), (loss, bool))]
        return pa.RecordBatch.from_arrays([
            pa.array([p[0] for p in pieces], pa.int64()), pa.array([p[1] for p in pieces], pa.int64()),
            pa.array([p[2] for p in pieces], pa.bool_()), pa.array([len(p[3]) for p in pieces], pa.int64()),
            pa.array([text for text, _, _ in made], pa.string()), *lists], [c.split()[0] for c in _PIECES.split(", ")])


def format_conversations(conversations: DataFrame, tokenizer_json: str, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Pieces ``conv_id, piece, whole, n_turns, formatted, ids, ends, loss`` of ``conv_id, turn, role, text``.

    ``ends`` are the bytes of ``formatted`` in UTF-8 up to the end of each token, ``loss`` says which tokens are text
    of the roles in ``learn``. ``whole`` says that the piece is all of its conversation; at the borders of a task
    that is not known and false.
    """
    held = conversations.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter, number = Formatter(held.value, learn), TaskContext.get().partitionId() << 32
        ready, turns, conv, chars, waiting, parts = [], [], None, 0, 0, 0
        first = True  # still in the task's first conversation

        def close(whole: bool) -> None:
            nonlocal turns, chars, waiting, number
            ready.append((conv, number, whole, turns))
            number, waiting, turns, chars = number + 1, waiting + chars, [], 0

        for batch in batches:
            for one, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if turns and one != conv:
                    close(whole=not first and not parts)
                    first, parts = False, 0
                elif turns and chars >= PIECE_CHARS:
                    close(whole=False)
                    parts += 1
                if waiting >= _BATCH_CHARS or len(ready) >= 1024:
                    yield formatter.encoded(ready)
                    ready, waiting = [], 0
                conv = one
                turns.append((role, text))
                chars += len(role) + len(text)
        if turns:
            close(whole=False)
        if ready:
            yield formatter.encoded(ready)

    blank = F.lit("")
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce(F.col("text").cast("string"), blank).alias("text"))
    # The last key tells equal rows apart, so that many of them spread as well.
    rows = rows.withColumns({"hash": F.xxhash64("text"), "tie": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange("conv_id", "turn", "role", "hash", "tie").sortWithinPartitions(
        "conv_id", "turn", "role", "hash", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, _PIECES)


_READ = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_OPEN = "piece bigint, formatted string, ends array<int>, loss array<boolean>"


class _Digest:
    """Running digests of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, template: Template, formatted: str, ends: np.ndarray, loss: np.ndarray) -> "_Digest":
        self.formatted_chars += len(formatted)
        for role, text in template.turns(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        # Runs of tokens under the mask; between two texts stand tokens that are not.
        edges, data = np.flatnonzero(np.diff(np.concatenate(([0], loss.view(np.int8), [0])))), formatted.encode()
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            text = template.unescape(data[ends[i - 1] if i else 0:ends[j - 1]].decode())
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        return self

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars)


def _of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Conversation, formatted text, ends and mask of every row."""
    ends, loss = batch.column("ends"), batch.column("loss")
    for k, (conv, formatted) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist())):
        yield conv, formatted, *(x[k].values.to_numpy(zero_copy_only=False) for x in (ends, loss))


def read_back(pieces: DataFrame, special: tuple[str, ...] = ("<|endoftext|>",)) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of every conversation, from its pieces.

    ``special`` are the names of the tokenizer's special tokens, by which texts were escaped. Whole conversations are
    digested as they come; only pieces of others are kept, brought together and digested in their order.
    """
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(special)
        for batch in batches:
            done = batch.filter(batch.column("whole"))
            rows = [_Digest(conv).add(template, *rest).row() for conv, *rest in _of(done)]
            if rows:
                yield _rows(rows, open_piece=True)
            rest = batch.filter(pc.invert(batch.column("whole")))
            if rest.num_rows:
                yield pa.RecordBatch.from_arrays([
                    rest.column("conv_id") if n == "conv_id" else pa.nulls(rest.num_rows, kind) for n, kind in _KINDS]
                    + [rest.column(c.split()[0]) for c in _OPEN.split(", ")], _NAMES)

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, digest = Template(special), None
        for batch in batches:
            done = []
            for conv, *rest in _of(batch):
                if digest is None or digest.conv_id != conv:
                    done += [digest.row()] if digest else []
                    digest = _Digest(conv)
                digest.add(template, *rest)
            if done:
                yield _rows(done)
        if digest:
            yield _rows([digest.row()])

    found = cut_lineage(pieces.mapInArrow(whole, f"{_READ}, {_OPEN}"))
    cut = found.where("n_turns is null").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return found.where("n_turns is not null").select(*[n for n, _ in _KINDS]).union(
        cut.select("conv_id", "formatted", "ends", "loss").mapInArrow(several, _READ))


_KINDS = [(c.split()[0], pa.int64() if c.endswith("bigint") else pa.string()) for c in _READ.split(", ")]
_NAMES = [c.split()[0] for c in f"{_READ}, {_OPEN}".split(", ")]
_OPEN_KINDS = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_()))


def _rows(rows: list[tuple], open_piece: bool = False) -> pa.RecordBatch:
    """Digests, with empty columns of an open piece if asked."""
    columns = [pa.array(column, kind) for column, (_, kind) in zip(zip(*rows), _KINDS)]
    empty = [pa.nulls(len(rows), kind) for kind in _OPEN_KINDS] if open_piece else []
    return pa.RecordBatch.from_arrays(columns + empty, _NAMES[:len(columns) + len(empty)])


SQL = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
    SELECT *, length(regexp_replace(text, '(<)(\\*(?:/?s>|\|endoftext\|>))|(\[)(\\*(?:/?INST|/?TURN|TEXT)\])', '\1\3\\\2\4', 'g')) AS body,
           length(regexp_replace(role, '(<)(\\*(?:/?s>|\|endoftext\|>))|(\[)(\\*(?:/?INST|/?TURN|TEXT)\])', '\1\3\\\2\4', 'g')) AS name
    FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(body + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE name + 19 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""
