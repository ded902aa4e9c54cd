"""Conversations as training text, by a compiled template, and back.

Control strings inside roles and texts are escaped, so the marks of the template are the
only ones in the output and reading it back gives every role and text again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladewerk.llm.common import partitions
from ladewerk.llm.template import TemplateError, compile_template

TEMPLATE = (
    "{% for message in messages %}"
    "{{ '<|im_start|>' + (message.role | role) + '\\n' }}"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "{{ '<|im_end|>' ~ '\\n' }}"
    "{% endfor %}"
)
TURN = re.compile(r"(?s)<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n")
BATCH_CHARS = 1 << 20
PARTS = "conv_id long, part long, text string, begins array<long>, ends array<long>"
_NAMED = {"n": "\n", "r": "\r"}


def escape(text: str | None) -> str:
    """A backslash is doubled, and one is put between < and |."""
    return (text or "").replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(role: str | None) -> str:
    return escape(role).replace("\n", "\\n").replace("\r", "\\r")


def unescape(text: str) -> str:
    return re.sub(r"(?s)\\(.)", r"\1", text)


def unescape_role(role: str) -> str:
    return re.sub(r"(?s)\\(.)", lambda m: _NAMED.get(m[1], m[1]), role)


@cache
def _renderer(source: str):
    return compile_template(source, {"escape": escape, "role": escape_role})


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, part, text, begins, ends: the formatted conversation in parts, in order.

    turns: conv_id, turn, role, text; other columns are not read. begins and ends are the
    code points of the part that a model is trained to write. The template renders a whole
    conversation, over whose `messages` it may loop once (another loop is an error); what
    it makes of one turn is a part, given on before the next turn is read, so a conversation
    of any length is never held whole. The parts of one lie together and in order in one
    partition. Turns go by turn, role and
    text (null first), repeated rows stay; null roles and texts are empty; rows with a null
    conv_id are one conversation. An empty table gives no rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = _renderer(template)
        done: list[tuple] = []
        size = 0
        for conv_id, own in groupby(rows(batches), key=lambda r: r[0]):
            for part in _parts(render, own):
                done.append((conv_id, *part))
                size += len(part[1])
                if size >= BATCH_CHARS:
                    yield _batch(done)
                    done, size = [], 0
        if done:
            yield _batch(done)

    n = partitions(turns)
    ordered = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, PARTS)


class _Turns:
    """The turns of a conversation as a template sees them: one after another, once."""

    def __init__(self, own: Iterator[tuple]) -> None:
        self.own, self.taken = own, -1

    def __iter__(self) -> Iterator[dict]:
        if self.taken >= 0:
            raise TemplateError("a template can run over the messages once")
        self.taken = 0
        for _, role, text in self.own:
            self.taken += 1
            yield {"role": role or "", "text": text or ""}


def _parts(render, own: Iterator[tuple]) -> Iterator[tuple]:
    """(part, text, begins, ends) of one conversation, which the template renders as a whole,
    turn by turn as they come. A part ends where the next turn begins; what stands before
    the first turn or behind the last one is in their parts."""
    turns = _Turns(own)
    pieces: list[str] = []
    begins: list[int] = []
    ends: list[int] = []
    part = at = held = 0
    for piece, generated in render({"messages": turns}):
        if turns.taken > max(held, 1) and pieces:
            yield part, "".join(pieces), begins, ends
            pieces, begins, ends, part, at = [], [], [], part + 1, 0
        held = turns.taken
        if generated and piece:
            if ends and ends[-1] == at:
                ends[-1] += len(piece)
            else:
                begins.append(at)
                ends.append(at + len(piece))
        pieces.append(piece)
        at += len(piece)
    if pieces:
        yield part, "".join(pieces), begins, ends


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["conv_id", "part", "text", "begins", "ends"])


def read_conversations(parts: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of formatted
    conversations, read from their text. parts come as format_conversations gives them:
    those of a conversation together and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*[batch.column(i).to_pylist() for i in (0, 2, 3, 4)], strict=True)

        done = []
        for conv_id, own in groupby(rows(), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = chars = 0
            rest = ""
            for _, text, begins, ends in own:
                chars += len(text)
                for a, b in zip(begins, ends, strict=True):
                    trained = unescape(text[a:b])
                    loss_chars += len(trained)
                    loss.update(trained.encode())
                rest += text
                at = 0
                for m in TURN.finditer(rest):
                    n += 1
                    turns.update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
                    at = m.end()
                rest = rest[at:]
            done.append((conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(done) >= 5000:
                yield digest(done)
                done = []
        if done:
            yield digest(done)

    def digest(done):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return parts.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
