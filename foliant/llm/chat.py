"""Chat formatting in budgeted windows.

A conversation's turns are counted in tokens; their prefix sums choose runs of whole
turns that fit a budget.  Each window holds the system turn, a limited number of tokens
of turns repeated from the window before as history, and then new turns.  Only new
assistant texts stand under the loss mask, so each is learnt from once.

Template: ``<|role|>``, a line feed, the text, ``<|end|>`` and a line feed.  A role or text
may contain anything: after the first character of every control string of common
templates inside it a backslash is put, and backslashes are doubled; ``unescape``
undoes both exactly.

A turn that alone exceeds the budget gets a window of its own and is not cut: the budget
bounds how many turns share a window.  One conversation is one row and must fit in a task.

Defined results for odd input: null texts and roles count as empty; turns are ordered
by number (null first), then role, then text, so repeated rows stay repeated turns; a null
conversation id is a conversation of its own; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .packing import default_vocabulary, encoder, token_ids

#: Control strings that must not appear unescaped inside a text.
CONTROL = ("<|", "|>", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>")
BUDGET, HISTORY = 2048, 512

_HEADS = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_TURN = re.compile(r"<\|((?:[^|\\]|\\.|\|(?!>))*)\|>\n(.*?)<\|end\|>\n", re.S)


def escape(text: str) -> str:
    return _HEADS.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def windows_of(tokens: list[int], system: int, *, budget: int = BUDGET, history: int = HISTORY) -> list[tuple[int, int, int]]:
    """Windows ``(first repeated turn, first new turn, end)`` over turns after ``system`` of them.

    ``tokens``: of all turns.  The system turns open every window and count against its budget.
    """
    sums = [0]
    for n in tokens:
        sums.append(sums[-1] + n)
    room, out, at, n = budget - sums[system], [], system, len(tokens)
    while at < n:
        back = at
        while back > system and sums[at] - sums[back - 1] <= history:
            back -= 1
        # History gives way where the next new turn would not fit beside it.
        while back < at and sums[at + 1] - sums[back] > room:
            back += 1
        end = at + 1
        while end < n and sums[end + 1] - sums[back] <= room:
            end += 1
        out.append((back, at, end))
        at = end
    return out or [(system, system, system)]


def format_conversation(turns: list[tuple[str, str]], count, *, budget: int = BUDGET, history: int = HISTORY):
    """Windows ``(text, turns repeated, [(start, end), ...])``; spans of the loss mask in code points."""
    parts = [(escape(role), escape(text)) for role, text in turns]
    tokens = [count(f"<|{r}|>\n{t}<|end|>\n") for r, t in parts]
    system = 1 if turns and turns[0][0] == "system" else 0
    out = []
    for number, (back, new, end) in enumerate(windows_of(tokens, system, budget=budget, history=history)):
        text, at, mask = [], 0, []
        for i in [*range(system), *range(back, end)]:
            role, body = parts[i]
            head = f"<|{role}|>\n"
            start = at + len(head)
            if turns[i][0] == "assistant" and (i >= new):
                mask.append((start, start + len(body)))
            piece = f"{head}{body}<|end|>\n"
            text.append(piece)
            at += len(piece)
        repeated = (system if number else 0) + new - back
        out.append(("".join(text), repeated, mask))
    return out


WINDOWS = "conv_id bigint, window int, text string, repeated int, mask array<struct<start:int,end:int>>"


def format_windows(rows: DataFrame, *, budget: int = BUDGET, history: int = HISTORY, vocabulary: str | None = None) -> DataFrame:
    """Windows of all conversations in ``rows`` (``conv_id, turn, role, text``).

    ``repeated`` turns after the leading ones that a first window would not have are history:
    the system turn of later windows and the turns taken up again.
    """
    vocabulary = vocabulary or default_vocabulary()
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").cast("bigint").alias("turn"), clean("role").alias("role"), clean("text").alias("text"))
    talks = rows.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def run(batches):
        enc = encoder(vocabulary)
        count = lambda text: len(token_ids(enc, text))
        for batch in batches:
            out = [[], [], [], [], []]
            for conv, turns in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = format_conversation([(t["role"], t["text"]) for t in turns.as_py()], count, budget=budget, history=history)
                for k, (text, repeated, mask) in enumerate(found):
                    for column, x in zip(out, (conv, k, text, repeated, [{"start": a, "end": b} for a, b in mask]), strict=True):
                        column.append(x)
            mask_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            types = (pa.int64(), pa.int32(), pa.string(), pa.int32(), mask_type)
            names = ["conv_id", "window", "text", "repeated", "mask"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return talks.mapInArrow(run, WINDOWS)


def read_back(windows: list[tuple[str, int, list[tuple[int, int]]]]) -> tuple[list[tuple[str, str]], list[str]]:
    """Turns and learnt texts that the windows (in order) spell out."""
    turns, learnt = [], []
    for text, repeated, mask in windows:
        found = [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]
        turns += found[repeated:]
        learnt += [unescape(text[a:b]) for a, b in mask]
    return turns, learnt


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint,"
    " n_windows bigint"
)


def digest_windows(windows: DataFrame) -> DataFrame:
    """Per conversation what its windows say when they are read back."""
    window = F.struct("window", "text", "repeated", "mask")
    talks = windows.groupBy("conv_id").agg(F.sort_array(F.collect_list(window)).alias("windows"))

    def run(batches):
        for batch in batches:
            out = [[], [], [], [], [], [], []]
            for conv, found in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                w = [(x["text"], x["repeated"], [(m["start"], m["end"]) for m in x["mask"]]) for x in found.as_py()]
                turns, learnt = read_back(w)
                said = "".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass")
                loss = "".join(learnt)
                values = (
                    conv, len(turns), hashlib.sha256(said).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), sum(len(t) for t, _, _ in w), len(w),
                )
                for column, x in zip(out, values, strict=True):
                    column.append(x)
            i, s = pa.int64(), pa.string()
            names = [x.split()[0] for x in DIGESTS.split(",")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (i, i, s, i, s, i, i), strict=True)], names)

    return talks.mapInArrow(run, DIGESTS)


def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the fixed one -7, formatted and read back."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    fixed = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return digest_windows(format_windows(rows.unionByName(fixed)))
