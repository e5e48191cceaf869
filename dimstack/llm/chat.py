"""Chat formatting: whole conversations as one string, one encoding with
character offsets, and a loss mask from the overlap of turn and token spans."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import ship_package

#: Control strings of the template: a turn is START role SEP text END.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = (START, SEP, END)
TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}", re.S)
#: Characters of output that are gathered before they are handed on.
FLUSH = 4_000_000


def escape(text: str) -> str:
    """One more bar after every ``<`` that bars follow: no control string (one
    bar) is left, and ``unescape`` restores the text."""
    return re.sub(r"<(\|+)", r"<|\1", text)


def unescape(text: str) -> str:
    return re.sub(r"<\|(\|+)", r"<\1", text)


@lru_cache(maxsize=2)
def chat_tokenizer(path: str):
    """The byte-level tokenizer of ``path``, read once per worker, with the control strings as special
    tokens (ids behind its own), so that no token spans the edge of a text, and
    offsets that keep leading white space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer, processors
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    tok.post_processor = processors.ByteLevel(trim_offsets=False)
    tok.add_special_tokens([AddedToken(c, special=True, normalized=False) for c in CONTROLS])
    return tok


def render(turns: list[tuple[str, str]], trained: frozenset[str]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted conversation, character spans of the texts of trained roles)."""
    parts: list[str] = []
    spans, at = [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        if role in trained and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for the tokens that overlap a span.  Token starts and ends ascend, also
    where several tokens share one character, so each span is a binary search."""
    mask = np.zeros(len(offsets), np.uint8)
    if len(offsets) and spans:
        span = np.array(spans)
        first = np.searchsorted(offsets[:, 1], span[:, 0], "right")
        last = np.searchsorted(offsets[:, 0], span[:, 1], "left")
        for lo, hi in zip(first.tolist(), last.tolist()):
            mask[lo:hi] = 1
    return mask


def _string(value: pa.Scalar) -> str:
    return (value.as_py() or b"").decode("utf-8", "replace")


def format_conversations(turns: DataFrame, tokenizer_path: str, trained: tuple[str, ...] = ("assistant",),
                         id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """One row per conversation: ``(id_col, n_turns, formatted, token_ids,
    loss_mask)``; ids as little-endian unsigned 32-bit binary, the mask one byte
    a token.

    Turns are in the order of ``order_col``, NULL first, ties by role and text.
    A NULL role or text is empty; rows with a NULL id are one conversation;
    repeated rows are turns like any other; other columns are ignored; an empty
    table gives an empty result.  Conversations are dealt by id and read as a
    sorted stream, so a task holds one of them at a time; its row must fit
    into a task's memory (about 60 bytes of Python for each byte of text).
    """
    ship_package(turns.sparkSession)
    rows = (turns.select(F.col(id_col), F.col(order_col).alias("__order"), F.col(role_col).alias("__role"),
                         F.col(text_col).alias("__text"))
            .repartition(id_col).sortWithinPartitions(id_col, F.col("__order").asc_nulls_first(), "__role", "__text")
            .select(id_col, F.col("__role").cast("binary"), F.col("__text").cast("binary")))
    schema = (turns.select(id_col).schema.add("n_turns", "long").add("formatted", "string")
              .add("token_ids", "binary").add("loss_mask", "binary"))
    arrow = to_arrow_schema(schema)
    roles = frozenset(trained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = chat_tokenizer(tokenizer_path)
        out: list[tuple] = []
        size = 0

        def row(conv, said: list[tuple[str, str]]) -> tuple:
            text, spans = render(said, roles)
            got = tok.encode(text, add_special_tokens=False)
            offsets = np.fromiter(chain.from_iterable(got.offsets), np.int64, 2 * len(got)).reshape(-1, 2)
            return (conv, len(said), text, np.array(got.ids, "<u4").tobytes(), loss_mask(offsets, spans).tobytes())

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], schema=arrow)
            out.clear()
            return batch

        for conv, said in _conversations(batches):
            out.append(row(conv, said))
            size += len(out[-1][2])
            if size > FLUSH:
                yield flush()
                size = 0
        if out:
            yield flush()

    return rows.mapInArrow(run, schema)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple[str, str]]]]:
    """(id, [(role, text)]) of rows whose ids are side by side."""
    last: object = None
    said: list[tuple[str, str]] = []
    for batch in batches:
        for conv, role, text in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            if said and conv != last:
                yield last, said
                said = []
            last = conv
            said.append((_string(role), _string(text)))
    if said:
        yield last, said


def read_formatted(formatted: DataFrame, tokenizer_path: str, id_col: str = "conv_id") -> DataFrame:
    """``(id_col, turns, loss_texts, formatted_chars)`` from nothing but the
    token ids and the mask: the turns (role, text) of the decoded string, and
    what each unbroken stretch of masked tokens says, both unescaped.

    A NULL or empty id list has no turns.  An empty table gives an empty result;
    other columns are ignored.
    """
    ship_package(formatted.sparkSession)
    src = formatted.select(id_col, "token_ids", "loss_mask")
    new = "turns array<struct<role: string, text: string>>, loss_texts array<string>, formatted_chars bigint"
    schema = StructType([*formatted.select(id_col).schema.fields, *StructType.fromDDL(new).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = chat_tokenizer(tokenizer_path)

        def read(raw: bytes, masked: bytes) -> tuple:
            ids, mask = np.frombuffer(raw, "<u4"), np.frombuffer(masked, np.uint8)
            text = tok.decode(ids.tolist(), skip_special_tokens=False)
            edge = np.flatnonzero(np.diff(np.r_[0, mask, 0].astype(np.int8)))
            said = [unescape(tok.decode(ids[a:b].tolist(), skip_special_tokens=False))
                    for a, b in zip(edge[::2], edge[1::2])]
            turns = [{"role": unescape(r), "text": unescape(t)} for r, t in TURN.findall(text)]
            return turns, said, len(text)

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                got = [read(i.as_py() or b"", m.as_py() or b"") for i, m in zip(part.column(1), part.column(2))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, t) for c, t in zip(zip(*got), arrow.types[1:]))], schema=arrow)

    return src.mapInArrow(run, schema)
