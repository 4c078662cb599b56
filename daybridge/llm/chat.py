"""Conversations as training text, with a mask that is exact to the character."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, processors

from daybridge.llm.common import corpus_session

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"

# The marks of a turn, and strings that mean control to this or another template.
BEGIN, END = "<|im_start|>", "<|im_end|>"
CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

# The encoder gets a conversation in pieces of whole turns of about so many code points, and rows leave a task when
# they hold as many. Marks part the encoding, so it is the same as of the whole text.
PIECE_CHARS = 1 << 20

_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))


def escape(text: str) -> str:
    """Backslashes doubled, and one put after the first character of each control string."""
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def escape_role(role: str) -> str:
    """As a text, and a line break as a slash and n: the first real one ends the role."""
    return re.sub(r"\\|\n|" + _CONTROL.pattern, lambda m: {"\\": "\\\\", "\n": "\\n"}.get(
        m[0], f"{m[0][0]}\\{m[0][1:]}"), role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|n|)", lambda m: "\n" if m[1] == "n" else m[1], role)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of turns (role, text), and for each the span of its escaped text."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{BEGIN}{escape_role(role)}\n", escape(text)
        parts += [head, body, f"{END}\n"]
        spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


_TURN = re.compile(re.escape(BEGIN) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered text."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def token_mask(turns: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens (index) that lie in turn spans, and the part of the token that does.

    Both are arrays of begin and end, sorted; the tokens of each span are found by binary search.
    """
    first = np.searchsorted(tokens[:, 1], turns[:, 0], "right")
    past = np.maximum(first, np.searchsorted(tokens[:, 0], turns[:, 1], "left"))
    counts = past - first
    index = np.repeat(first - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
    span = np.repeat(np.arange(len(turns)), counts)
    clipped = np.stack([np.maximum(tokens[index, 0], turns[span, 0]), np.minimum(tokens[index, 1], turns[span, 1])], 1)
    return index, clipped


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted spans with those that touch or overlap made one."""
    if not len(spans):
        return spans.reshape(0, 2)
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.r_[True, spans[1:, 0] > reach[:-1]])
    return np.stack([spans[new, 0], np.r_[reach[new[1:] - 1], reach[-1]]], 1)


@cache
def _tokenizer(path: str) -> Tokenizer:
    found = Tokenizer.from_file(path)
    found.add_special_tokens([AddedToken(mark, special=True, normalized=False) for mark in (BEGIN, END)])
    found.post_processor = processors.ByteLevel(trim_offsets=False)
    return found


FORMATTED = "conv_id bigint, text string, tokens array<int>, mask array<boolean>, loss_spans array<struct<first: int, past: int>>"
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))


def _pieces(text: str, spans: list[tuple[int, int]], piece_chars: int) -> list[tuple[int, int]]:
    """Begin and end of the encoder's pieces of a rendered text: cuts lie behind turns."""
    cuts = [0]
    for _, past in spans:
        if past - cuts[-1] >= piece_chars:
            cuts.append(past + len(END) + 1)
    return list(zip(cuts, [*cuts[1:], len(text)]))


def _encoded(conversations: list[tuple[int | None, list[tuple[str, str]]]], tokenizer: str,
             learned: frozenset[str], piece_chars: int) -> pa.RecordBatch:
    rendered = [render(turns) for _, turns in conversations]
    pieces = [_pieces(text, spans, piece_chars) for text, spans in rendered]
    encodings = iter(_tokenizer(tokenizer).encode_batch(
        [text[a:b] for (text, _), cuts in zip(rendered, pieces) for a, b in cuts], add_special_tokens=False))
    tokens, masks, losses = [], [], []
    for (_, turns), (_, spans), cuts in zip(conversations, rendered, pieces):
        ids, offsets = [], []
        for (a, _), encoding in zip(cuts, encodings):
            ids.append(np.array(encoding.ids, np.int32))
            offsets.append(np.fromiter(chain.from_iterable(encoding.offsets), np.int64, 2 * len(encoding)).reshape(-1, 2) + a)
        ids, offsets = np.concatenate(ids), np.concatenate(offsets)
        wanted = np.array([s for s, (role, _) in zip(spans, turns) if role in learned], np.int64).reshape(-1, 2)
        index, parts = token_mask(wanted, offsets)
        mask = np.zeros(len(offsets), bool)
        mask[index] = True
        tokens.append(ids)
        masks.append(mask)
        losses.append([{"first": a, "past": b} for a, b in merged(parts[parts[:, 1] > parts[:, 0]]).tolist()])
    return pa.record_batch([pa.array([c[0] for c in conversations], pa.int64()),
                            pa.array([text for text, _ in rendered], pa.string()),
                            pa.array(tokens, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.bool_())),
                            pa.array(losses, _SPANS)],
                           ["conv_id", "text", "tokens", "mask", "loss_spans"])


def format_conversations(turns: DataFrame, tokenizer: str = TOKENIZER, learned: tuple[str, ...] = ("assistant",),
                         conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """A row for each conversation: ``conv_id, text, tokens, mask, loss_spans``.

    ``text`` renders all turns, ``tokens`` encodes it once, ``mask`` marks tokens that reach into a text of a
    ``learned`` role, and ``loss_spans`` are the code points of those texts that tokens cover, merged.
    Turns go by number, then role, then text, null first; null roles and texts are empty; repeated rows are
    turns of their own; a null conv_id is one conversation; an empty table gives no rows. A conversation is
    one row whatever its length, so it has to be below the 2 GB of a value; a longer one is an error.

    Rows are dealt out by conversation and sorted; a task streams them and holds one conversation at a time, or
    several that have about ``piece_chars`` code points together.
    """
    corpus_session(turns.sparkSession)
    rows = (turns.select(F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
                         F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn"))
    roles = frozenset(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, waiting, current, turns_ = [], 0, None, []
        for batch in batches:
            for conv, role_, text_ in zip(*[c.to_pylist() for c in batch.columns]):
                if turns_ and conv != current:
                    done.append((current, turns_))
                    turns_ = []
                    if waiting >= piece_chars:
                        yield _encoded(done, tokenizer, roles, piece_chars)
                        done, waiting = [], 0
                current = conv
                turns_.append((role_, text_))
                waiting += len(text_)
        if turns_:
            done.append((current, turns_))
        if done:
            yield _encoded(done, tokenizer, roles, piece_chars)

    return rows.mapInArrow(run, FORMATTED)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say when they are read back, a row for each, in whatever order they come.

    ``n_turns``; ``turns_sha256`` over role, \\n, text, \\n of each turn; ``loss_chars`` and ``loss_sha256`` of
    all text under the mask, unescaped; ``formatted_chars``.
    """

    def read(conv: int | None, text: str, spans: list[dict]) -> tuple:
        turns = read_back(text)
        loss = [unescape(text[span["first"]:span["past"]]) for span in spans]
        told = hashlib.sha256()
        for role, said in turns:
            told.update(f"{role}\n{said}\n".encode())
        return (conv, len(turns), told.hexdigest(), sum(map(len, loss)),
                hashlib.sha256("".join(loss).encode()).hexdigest(), len(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _digest_rows([read(*row) for row in zip(*[c.to_pylist() for c in batch.columns])])

    return formatted.select("conv_id", "text", "loss_spans").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 6
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)],
                           ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
