"""Conversations as training text with a loss mask over the assistant's tokens.

A conversation is rendered whole, encoded once, and its mask found by intersecting two sorted lists of spans,
those of the turns and those of the tokens, by binary search.

*Template.* ``<|turn|>role<|says|>text<|end|>`` for each turn, nothing between turns. The three markers are special
tokens, so no token reaches over the border of a text. In roles and texts the control strings of this and of
other common templates are escaped: their first character becomes ``\\l`` (for ``<``) or ``\\b`` (for ``[``), and
a backslash becomes two. That undoes itself uniquely (``unescaped``), and no text can close its own turn.

Turns go by number, ties by role and text, null numbers first. Null text and role are empty. Repeated rows are
turns of their own. A row without ``conv_id`` belongs to no conversation and is one by itself. A conversation is
one text for the encoder, so its turns come together in one task; all else is spread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm.shared import python_tasks

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
LEARNT_ROLE = "assistant"
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
# The vocabulary file is read by the driver and sent to each executor once.
MOST_TOKENIZER_BYTES = 64 * 2**20

# Control strings of common chat templates, besides the markers above.
CONTROL = re.compile(r"<\||\[/?INST\]|</?s>|<</?SYS>>|<(?:start|end)_of_turn>")
_ESCAPE = {"<": "\\l", "[": "\\b"}
_PLAIN = {"\\": "\\", "l": "<", "b": "["}
_ESCAPED = re.compile(r"\\([\\lb])")
_TURNS = re.compile(r"<\|turn\|>(.*?)<\|says\|>(.*?)<\|end\|>", re.S)


def escaped(text: str) -> str:
    return CONTROL.sub(lambda m: _ESCAPE[m[0][0]] + m[0][1:], text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text)


def rendered(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans (code points) of the texts to be learnt."""
    pieces, spans, at = [], [], 0
    for role, text in turns:
        body = escaped(text)
        head = f"{TURN}{escaped(role)}{SAYS}"
        if role == LEARNT_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        pieces += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(pieces), spans


def token_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in a span; both lists are sorted, so two searches for each span find them."""
    mask = np.zeros(len(starts), bool)
    for low, high in spans:
        first, last = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")
        mask[first:last] = True
    return mask


def read_back(formatted: str) -> list[tuple[str, str]]:
    return [(unescaped(role), unescaped(text)) for role, text in _TURNS.findall(formatted)]


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """What the mask covers, unescaped. Several tokens may stand for one character; it counts once."""
    out, reached = [], 0
    for start, end in zip(starts[mask].tolist(), ends[mask].tolist()):
        out.append(formatted[max(start, reached):end])
        reached = max(reached, end)
    return unescaped("".join(out))


def load_tokenizer(text: str):
    from tokenizers import AddedToken, Tokenizer, processors

    tokenizer = Tokenizer.from_str(text)
    tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (TURN, SAYS, END)])
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets keep the space of a word
    return tokenizer


def _formatter(vocabulary):
    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = load_tokenizer(vocabulary.value)
        for batch in batches:
            texts, spans = [], []
            for turns in batch.column("turns").to_pylist():
                text, learnt = rendered([(t["role"], t["text"]) for t in turns])
                texts.append(text)
                spans.append(learnt)
            columns: dict[str, list] = {"ids": [], "starts": [], "ends": [], "mask": []}
            for text, learnt in zip(texts, spans):
                found = tokenizer.encode(text, add_special_tokens=False)
                offsets = np.array(found.offsets, np.int32).reshape(-1, 2)
                columns["ids"].append(np.array(found.ids, np.int32))
                columns["starts"].append(offsets[:, 0])
                columns["ends"].append(offsets[:, 1])
                columns["mask"].append(token_mask(offsets[:, 0], offsets[:, 1], learnt))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(texts, pa.string()),
                 *[pa.array(columns[c], pa.list_(pa.int32())) for c in ("ids", "starts", "ends")],
                 pa.array(columns["mask"], pa.list_(pa.bool_()))],
                ["conv_id", "formatted", "ids", "starts", "ends", "mask"])
    return formatted


def format_conversations(rows: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """conv_id, formatted, ids, starts, ends and mask: one row for each conversation in ``rows`` (conv_id, turn,
    role, text). ``starts`` and ``ends`` are the tokens' code-point offsets in ``formatted``."""
    spark: SparkSession = rows.sparkSession
    python_tasks(spark, 200)
    with open(tokenizer, encoding="utf-8") as file:
        vocabulary = file.read(MOST_TOKENIZER_BYTES + 1)
    if len(vocabulary) > MOST_TOKENIZER_BYTES:
        raise ValueError(f"{tokenizer} is too large to send to the executors")
    turns = rows.select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text")).alias("at"))
    whole = turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("at")).alias("turns"))
    single = turns.where("conv_id IS NULL").select("conv_id", F.array("at").alias("turns"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    return whole.union(single).mapInArrow(
        _formatter(spark.sparkContext.broadcast(vocabulary)),
        f"conv_id {kind}, formatted string, ids array<int>, starts array<int>, ends array<int>, mask array<boolean>")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from hashlib import sha256

    def hexed(text: str) -> str:
        return sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    for batch in batches:
        rows = []
        values = [batch.column(c).to_pylist() for c in ("formatted", "starts", "ends", "mask")]
        for formatted, starts, ends, mask in zip(*values):
            turns = read_back(formatted)
            loss = masked_text(formatted, np.array(starts, int), np.array(ends, int), np.array(mask, bool))
            rows.append((len(turns), hexed("".join(f"{role}\n{text}\n" for role, text in turns)), len(loss),
                         hexed(loss), len(formatted), len(starts), sum(mask)))
        columns = list(zip(*rows)) if rows else [()] * 7
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
            ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens",
             "n_loss_tokens"])


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say when read back from the output of ``format_conversations``."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(
        _digests, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
                  " formatted_chars long, n_tokens long, n_loss_tokens long")
