"""Chat formatting in budgeted windows (operator 6).

Turn tokens are summed along each conversation (``prefix.running``); the
running sum puts each turn into a block of half the window's own budget, and a
turn longer than that stands alone, so a window of several turns never exceeds
its budget and spans end at turns. Every window is formatted with the
conversation's system turn, a limited number of turns before it, and its own
turns; the loss mask covers the own assistant texts, so repeated targets are
masked out. Windows are found with aggregates and joins on (conversation,
place), so a conversation of any length spreads over many tasks.

A formatted window reads

    <|window FIRST|>
    <|turn N|>role
    text<|end|>

with control strings inside roles and texts escaped reversibly: a backslash is
doubled, ``<|`` becomes ``<\\|`` and a line break in a role ``\\n``.

Defined results: a null text or role is empty; a null conversation id is one
conversation of its own; turns with the same number go by role and text; null
turn numbers come first; repeated rows are turns of their own; an empty table
gives no windows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quillmart.llm.bpe import ByteEncoder, shared
from quillmart.llm.common import cut, map_batches, ship
from quillmart.llm.prefix import running

MARK_TOKENS = 8  # what the marks around a turn count for
CONV = ["none", "conv_id"]
WINDOWS = "conv_id long, first long, text string, loss array<struct<start: long, `end`: long>>, n_tokens long"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, n_windows long")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


_ESCAPED = re.compile(r"\\(.)|<\\\|", re.S)


def unescape(text: str) -> str:
    """Left to right: ``\\\\`` is a backslash, ``<\\|`` is ``<|``, ``\\n`` (in
    roles) a line break."""
    return _ESCAPED.sub(lambda m: "<|" if m.group(1) is None else "\n" if m.group(1) == "n" else m.group(1), text)


def format_window(first: int, turns: list[tuple[int, str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The window's text and the stretches under the loss mask. ``turns`` are
    (place, role, text) in order; those before ``first`` are repeated."""
    out, spans, at = [f"<|window {first}|>\n"], [], 0
    at = len(out[0])
    for place, role, text in turns:
        head = f"<|turn {place}|>{escape(role).replace(chr(10), chr(92) + 'n')}\n"
        body = escape(text)
        if role == "assistant" and place >= first:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, "<|end|>\n"]
        at += len(head) + len(body) + 8
    return "".join(out), spans


_TURN = re.compile(r"<\|turn (\d+)\|>([^\n]*)\n(.*?)<\|end\|>\n", re.S)
_WINDOW = re.compile(r"<\|window (\d+)\|>\n")


def read_window(text: str) -> list[tuple[int, str, str]]:
    """The own turns of a formatted window, unescaped: (place, role, text)."""
    m = _WINDOW.match(text)
    first = int(m.group(1))
    turns = ((int(t.group(1)), unescape(t.group(2)), unescape(t.group(3))) for t in _TURN.finditer(text, m.end()))
    return [t for t in turns if t[0] >= first]


def windows(conversations: DataFrame, vocabulary: str, budget: int = 1024, history: int = 2) -> DataFrame:
    """One row per window (WINDOWS). Of ``budget`` tokens a quarter is meant
    for the system turn and up to ``history`` repeated turns (those that fit
    it), the rest for the window's own turns."""
    own = budget - budget // 4

    def make():
        encoder = shared(ByteEncoder, vocabulary)

        def run(c: dict) -> dict:
            n = [len(i) + MARK_TOKENS for i in encoder.encode(c["text"])]
            return {**c, "tokens": n, "long": [int(x > own // 2) for x in n]}

        return run

    rows = conversations.select(
        F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id"),
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = map_batches(rows, make, "none boolean, conv_id long, turn long, role string, text string, "
                                      "tokens long, long long")
    turns = cut(running(counted, CONV, ["turn", "role", "text"], ["tokens", "long"])
                .select(*CONV, "idx", "role", "text", "tokens",
                        F.floor(F.col("tokens_before") / (own // 2)).alias("block"),
                        (2 * F.col("long_before") + F.col("long")).alias("stretch")))
    at = [*CONV, "block", "stretch"]
    spans = turns.groupBy(*at).agg(F.min("idx").alias("first"))
    mine = turns.join(spans, at).select(*CONV, "first", "idx", "role", "text", "tokens")
    # Places that a later window repeats: 0 (if it is a system turn) and the `history` before its first.
    wanted = spans.where("first > 0").select(*CONV, "first", F.explode(F.expr(
        f"array_distinct(concat(array(0L), sequence(greatest(first - {history}, 0L), first - 1)))"
        if history > 0 else "array(0L)")).alias("idx"))
    again = (wanted.join(turns, [*CONV, "idx"])
             .where(f"(idx = 0 AND role = 'system') OR (idx >= first - {history} AND tokens <= {budget // 8})")
             .select(*CONV, "first", "idx", "role", "text", "tokens"))
    grouped = (mine.unionByName(again).groupBy(*CONV, "first")
               .agg(F.sort_array(F.collect_list(F.struct("idx", "role", "text"))).alias("turns"),
                    F.sum("tokens").alias("n_tokens")))

    def make_text():
        def run(c: dict) -> dict:
            made = [format_window(f, [(t["idx"], t["role"], t["text"]) for t in turns])
                    for f, turns in zip(c["first"], c["turns"])]
            return {"conv_id": [None if n else i for n, i in zip(c["none"], c["conv_id"])], "first": c["first"],
                    "text": [t for t, _ in made], "n_tokens": c["n_tokens"],
                    "loss": [[{"start": a, "end": b} for a, b in spans] for _, spans in made]}

        return run

    return map_batches(grouped, make_text, WINDOWS)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation (DIGEST), read from the formatted windows
    alone. A digest over a whole conversation is sequential by nature, so a
    conversation's windows stream in order through one task; the task holds
    one window and two hash states."""
    ship(formatted.sparkSession)
    out = StructType.fromDDL(DIGEST)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def result() -> list:
            conv, turns, n, loss, chars, all_chars, count = state
            return [conv, n, turns.hexdigest(), chars, loss.hexdigest(), all_chars, count]

        for batch in batches:
            done = []
            conv_ids, texts, losses = (batch.column(i).to_pylist() for i in range(3))
            for conv, text, spans in zip(conv_ids, texts, losses):
                if state is None or conv != now:
                    if state is not None:
                        done.append(result())
                    now, state = conv, [conv, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                for _, role, said in read_window(text):
                    state[1].update(f"{role}\n{said}\n".encode())
                    state[2] += 1
                for s in spans:
                    under = unescape(text[s["start"]:s["end"]])
                    state[3].update(under.encode())
                    state[4] += len(under)
                state[5] += len(text)
                state[6] += 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(result(), arrow)], schema=arrow)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "first")
    return ordered.select("conv_id", "text", "loss").mapInArrow(run, out)
