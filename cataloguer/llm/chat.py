r"""Chat formatting: conversations rendered by a compiled template, with a loss mask.

Rows are dealt out by conversation and sorted by turn; a task streams each
conversation through the compiled template (``llm.template``), so it holds one
turn and at most one part of output at a time. The output has rows
``(conv_id, part, text, spans)``: the formatted text of a conversation, cut at a
turn's end into parts of about ``part_chars`` characters (nearly always one part),
and the spans ``[start, end)`` (code points of the part) of generated text.

Control strings in roles and texts are escaped reversibly: every ``<`` followed by
any number of backslashes and a ``|`` gets one backslash more, so no escaped text
holds ``<|``; ``unescape`` takes it away again. Backslashes and line ends of a role
are written ``\\`` and ``\n``, so a role is one line.

Defined cases: null role or text is empty; turns sort by (turn, role, text), so
ties and repeated rows have a fixed order and are all rendered; a null conv_id is a
conversation of its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .template import compile_template

START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% for message in messages -%}"
    "{{ '<|im_start|>' ~ message.role | escape | oneline ~ '\\n' }}"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "{{ '<|im_end|>' ~ '\\n' }}"
    "{%- endfor %}"
)
_FORMATTED = "conv_id long, part long, text string, spans array<struct<start:long,end:long>>"
_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    """Text without control strings (see module)."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    """Inverse of ``escape``."""
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def oneline(role: str) -> str:
    """A role on one line."""
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def unoneline(role: str) -> str:
    """Inverse of ``oneline``."""
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def format_conversations(conversations: DataFrame, template: str = TEMPLATE, part_chars: int = 1 << 20) -> DataFrame:
    """Rows (conv_id, part, text, spans); see the module."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = compile_template(template, {"escape": escape, "oneline": oneline})
        done: list[tuple] = []
        size = 0
        for conv_id, rows in groupby(_rows(batches), key=lambda r: r[0]):
            ended = [False]

            def messages(rows=rows, ended=ended):
                for _, role, text in rows:
                    ended[0] = True
                    yield {"role": role, "text": text}

            part, texts, spans, at = 0, [], [], 0
            for text, generated in run({"messages": messages()}):
                if not text:
                    continue
                if at >= part_chars and text.startswith(START):
                    done.append((conv_id, part, "".join(texts), spans))
                    size += at
                    part, texts, spans, at = part + 1, [], [], 0
                texts.append(text)
                if generated:
                    spans.append((at, at + len(text)))
                at += len(text)
                if size >= part_chars:
                    yield _formatted_batch(done, spans_type)
                    done, size = [], 0
            done.append((conv_id, part, "".join(texts), spans))
            size += at
        if done:
            yield _formatted_batch(done, spans_type)

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return (
        rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text").mapInArrow(render, _FORMATTED)
    )


def _formatted_batch(rows: list[tuple], spans_type: pa.DataType) -> pa.RecordBatch:
    ids, parts, texts, spans = zip(*rows)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array(parts, pa.int64()), pa.array(texts, pa.string()),
        pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], spans_type),
    ], ["conv_id", "part", "text", "spans"])


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted text of the standard template."""
    for chunk in text.split(START)[1:]:
        role, _, body = chunk.partition("\n")
        yield unescape(unoneline(role)), unescape(body.removesuffix(END + "\n"))


def digest_formatted(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from formatted rows that follow each other in part order."""
    names = [c.split()[0] for c in _DIGEST.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for conv_id, rows in groupby(_rows(batches), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = chars = total = 0
            for _, _, text, spans in rows:
                total += len(text)
                for role, body in read_turns(text):
                    n += 1
                    turns.update(f"{role}\n{body}\n".encode())
                for s in spans:
                    learned = unescape(text[s["start"] : s["end"]])
                    chars += len(learned)
                    loss.update(learned.encode())
            out.append((conv_id, n, turns.hexdigest(), chars, loss.hexdigest(), total))
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return formatted.mapInArrow(read, _DIGEST)
