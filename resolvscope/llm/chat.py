"""Chat formatting with loss masks that are aligned by offsets."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, processors

# The template's marks, and control strings of other templates that must not stand in a text either.
START, HEAD, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = [START, HEAD, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>"]
# Put after the first character of a control string; reading it back takes one away.
JOINER = "\u2060"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# Characters after which a conversation is encoded up to the last whole turn; only very long ones reach it.
LONG = 1 << 20

_REST = "|".join(re.escape(c[1:]) for c in sorted(CONTROLS, key=len, reverse=True))
_CONTROL = re.compile(f"([<\\[])({JOINER}*)(?={_REST})")
_ESCAPED = re.compile(f"([<\\[]){JOINER}({JOINER}*)(?={_REST})")
_TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(HEAD)}(.*?){re.escape(END)}", re.S)

SCHEMA = "conv_id long, part int, formatted string, input_ids array<int>, loss array<boolean>, loss_spans array<struct<start:int,end:int>>"


def escape(text: str) -> str:
    return _CONTROL.sub(rf"\1\2{JOINER}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one string, and the stretches of the assistant's texts in it."""
    made, spans, at = [], [], 0
    for role, text in turns:
        head = f"{START}{escape(role)}{HEAD}"
        body = escape(text)
        made += [head, body, END]
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
    return "".join(made), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tokens that touch a span. Spans and tokens are sorted, so two binary searches find a span's tokens."""
    mask = np.zeros(len(starts), dtype=bool)
    low = np.searchsorted(ends, [a for a, _ in spans], side="right")
    high = np.searchsorted(starts, [b for _, b in spans], side="left")
    for i, j in zip(low, high, strict=True):
        mask[i:j] = True
    return mask


def masked_stretches(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of text under runs of masked tokens."""
    edges = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0]))
    return [(int(starts[i:j].min()), int(ends[i:j].max())) for i, j in zip(edges[::2], edges[1::2], strict=True)]


def load_tokenizer(definition: str) -> Tokenizer:
    """The vocabulary with the marks as tokens of their own; offsets keep leading blanks."""
    tokenizer = Tokenizer.from_str(definition)
    tokenizer.add_special_tokens([AddedToken(t, special=True, normalized=False) for t in (START, HEAD, END)])
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    return tokenizer


def format_conversations(conversations: DataFrame, vocabulary: str = VOCABULARY, long: int = LONG) -> DataFrame:
    """Formatted conversations: conv_id, part, formatted, input_ids, loss (a flag for each token) and loss_spans.

    Rows are dealt to tasks by conversation and sorted by turn there, and tasks read them as a stream, so a conversation of
    any length takes bounded memory: it is encoded whole, or, beyond ``long`` characters, in parts that end with a turn.
    Marks are tokens of their own, so no token crosses from a mark into a text and the parts' tokens are those of the whole.
    Each part is encoded once; the offsets and the assistants' stretches are intersected by binary search.

    Control strings inside roles and texts get a joiner after their first character, which reading back takes away. Null
    texts and roles are empty. Turns that are equal or null are ordered by role and text, nulls first; repeated rows stay.
    Rows without a conv_id form one conversation. Other columns are ignored. The vocabulary is read by the driver.
    """
    with open(vocabulary, encoding="utf-8") as f:
        shared = conversations.sparkSession.sparkContext.broadcast(f.read())
    columns = [F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text")]
    ordered = conversations.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = load_tokenizer(shared.value)

        def made(conv: int | None, part: int, turns: list[tuple[str, str]]) -> dict:
            formatted, spans = render(turns)
            encoded = tokenizer.encode(formatted, add_special_tokens=False)
            offsets = np.array(encoded.offsets, dtype=np.int64).reshape(-1, 2)
            mask = loss_mask(offsets[:, 0], offsets[:, 1], spans)
            found = masked_stretches(mask, offsets[:, 0], offsets[:, 1])
            return {
                "conv_id": conv,
                "part": part,
                "formatted": formatted,
                "input_ids": np.array(encoded.ids, dtype=np.int32),
                "loss": mask,
                "loss_spans": [{"start": a, "end": b} for a, b in found],
            }

        def frame_of(rows: list[dict]) -> pd.DataFrame:
            out = pd.DataFrame(rows)
            out["conv_id"] = out["conv_id"].astype("Int64")
            return out

        current, part, turns, size, rows = None, 0, [], 0, []
        waiting = 0
        for frame in frames:
            ids = frame["conv_id"].astype("Int64")
            for conv, role, text in zip([None if pd.isna(i) else int(i) for i in ids], frame["role"], frame["text"], strict=True):
                if turns and (conv != current or size >= long):
                    rows.append(made(current, part, turns))
                    waiting += size
                    part = part + 1 if conv == current else 0
                    turns, size = [], 0
                elif conv != current:
                    part = 0
                current = conv
                turns.append((role, text))
                size += len(text) + len(role)
                if waiting >= long:
                    yield frame_of(rows)
                    rows, waiting = [], 0
        if turns:
            rows.append(made(current, part, turns))
        if rows:
            yield frame_of(rows)

    return ordered.mapInPandas(run, SCHEMA)


def summarise(formatted: DataFrame) -> DataFrame:
    """A row for each conversation with what is read back from its parts, which stand together and in order."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def row(conv: int | None, state: list) -> dict:
            turns, texts, n_turns, chars, lost = state
            return {"conv_id": conv, "n_turns": n_turns, "turns_sha256": turns.hexdigest(), "loss_chars": lost, "loss_sha256": texts.hexdigest(), "formatted_chars": chars}

        current, state = None, None
        for frame in frames:
            rows = []
            ids = frame["conv_id"].astype("Int64")
            for conv, part, text, spans in zip([None if pd.isna(i) else int(i) for i in ids], frame["part"], frame["formatted"], frame["loss_spans"], strict=True):
                if part == 0:
                    if state:
                        rows.append(row(current, state))
                    current, state = conv, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                for role, said in read_back(text):
                    state[0].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    state[2] += 1
                for span in spans:
                    under = unescape(text[span["start"] : span["end"]])
                    state[1].update(under.encode("utf-8", "surrogatepass"))
                    state[4] += len(under)
                state[3] += len(text)
            if rows:
                out = pd.DataFrame(rows)
                out["conv_id"] = out["conv_id"].astype("Int64")
                yield out
        if state:
            out = pd.DataFrame([row(current, state)])
            out["conv_id"] = out["conv_id"].astype("Int64")
            yield out

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInPandas(run, schema)
