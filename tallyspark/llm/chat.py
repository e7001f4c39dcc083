r"""Chat formatting with offset-aligned loss masks (operator 5).

A turn is written ``[INST]role[/INST]text</s>``. Control strings inside roles and texts get one backslash after
their first character, and those that have backslashes there one more, so that every text can be
read back: ``[INST]`` becomes ``[\INST]`` and ``[\INST]`` becomes ``[\\INST]``.

A conversation is rendered whole and encoded once, with offsets. The marks are added tokens, so no token
crosses the ends of a text. The spans of the assistant's texts and the tokens' spans are both sorted;
two binary searches a turn find the tokens under the loss mask.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, BODY, END = "[INST]", "[/INST]", "</s>"
_CONTROL = re.compile(r"([\[<])(\\*)(/?INST\]|/s>|\|endoftext\|>)")
_ESCAPED = re.compile(r"([\[<])\\(\\*)(/?INST\]|/s>|\|endoftext\|>)")
_TURNS = re.compile(r"\[INST\](.*?)\[/INST\](.*?)</s>", re.S)
SCHEMA = "formatted string, n_turns long, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = TURN + escape(role) + BODY, escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def mask(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens overlap a span; spans and tokens are in order of the text."""
    out = np.zeros(len(starts), bool)
    if spans:
        begin, end = np.array(spans, np.int64).T
        low, high = np.searchsorted(ends, begin, "right"), np.searchsorted(starts, end, "left")
        for a, b in zip(low.tolist(), high.tolist(), strict=True):
            out[a:b] = True
    return out


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> str:
    """All text under the mask, unescaped: each run of masked tokens from its first to its last character."""
    edge = np.flatnonzero(np.diff(loss.astype(np.int8), prepend=0, append=0))
    return "".join(unescape(formatted[starts[a] : ends[b - 1]]) for a, b in edge.reshape(-1, 2).tolist())


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts, read back."""
    return [(unescape(a), unescape(b)) for a, b in _TURNS.findall(formatted)]


_TOKENIZERS: dict = {}


def tokenizer(path: str):
    """The tokenizer file with the marks as added tokens, once for a worker."""
    if path not in _TOKENIZERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        t = Tokenizer.from_file(path)
        t.add_special_tokens([AddedToken(x, special=True, normalized=False) for x in (TURN, BODY, END)])
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


def format_conversations(turns: DataFrame, path: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``n_turns``, ``ids``, ``starts`` and ``ends`` (spans
    of the tokens in code points of ``formatted``) and ``loss`` (the mask).

    Turns go by turn number (null first; ties by role and text, so the order is defined); repeated rows are
    turns of their own. A null role or text is an empty one; rows of null conversation make one
    conversation. Only the four columns are read, so other columns of any name don't matter. Rows are
    sorted within partitions and read as a stream, so a task holds one conversation at a time.
    """
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *[c.split()[0] for c in SCHEMA.split(", ")]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode
        id_type = None

        def row(key, own: list[tuple[str, str]]) -> list:
            formatted, spans = render(own)
            found = encode(formatted, add_special_tokens=False)
            spans_of = np.array(found.offsets, np.int32).reshape(-1, 2)
            return [key, formatted, len(own), found.ids, spans_of[:, 0], spans_of[:, 1], mask(spans, spans_of[:, 0], spans_of[:, 1])]

        def out(done: list[list]) -> pa.RecordBatch:
            types = [id_type, pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.bool_())]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)

        now, own, done, size = (), [], [], 0
        for batch in batches:
            id_type = batch.column(0).type
            for key, r, t in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if (key,) != now:
                    if own:
                        done.append(row(now[0], own))
                        if size > 1_000_000:
                            yield out(done)
                            done, size = [], 0
                    now, own = (key,), []
                own.append((r, t))
                size += len(t)
        if own:
            done.append(row(now[0], own))
            yield out(done)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, f"conv_id {kind}, {SCHEMA}")


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them: ``conv_id``, ``n_turns``, ``turns_sha256``,
    ``loss_chars``, ``loss_sha256``, ``formatted_chars`` and ``n_tokens``."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                starts, ends, loss = (np.array(batch.column(k)[i].values.to_numpy(zero_copy_only=False)) for k in (2, 3, 4))
                turns = turns_of(text)
                said = masked_text(text, starts, ends, loss)
                rows.append((batch.column(0)[i].as_py(), len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), len(text), len(starts)))
            if rows:
                types = [batch.column(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"
    return formatted.select("conv_id", "formatted", "starts", "ends", "loss").mapInArrow(run, schema)
