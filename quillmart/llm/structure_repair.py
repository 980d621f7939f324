"""Conversation structure repair on a suffix-shared automaton (operator 11).

A conversation is sound when its role initials read ``(s?(ua)+)?``. Blank and
repeated turns must go; the cheapest edits make the rest sound: Keep (0),
Rerole to user or assistant (3), Delete (4), Insert an empty user or assistant
turn (3); a truncated turn that stays costs 3 more. Among the cheapest, the
edits whose initials are ASCII-least win.

1. Turns are range-partitioned in conversation order and get a place. A turn is
   a repeat if its (role, text) has an earlier place; the first places come
   from one aggregate per (conversation, role, text), so many copies collapse
   before the shuffle, and are found again by the unique place.
2. Neighbouring turns of a conversation form segments of at most
   ``SEGMENT`` turns, each with a signature: one letter per turn for its role
   and fault.
3. The distinct signatures of all conversations are ordered from their ends.
   Read in that order, a signature shares the nodes of its common suffix with
   the one before it, so each node (a suffix, and what follows the segment) of
   the automaton is made once in a task, whatever the number of conversations
   that pass through it; only the nodes common to two neighbouring tasks are
   made twice. A node holds, per grammar state, the cost to go and the best
   edit; the edits have different initials, so the best audit follows from the
   pointers without comparing strings. Memory is one path.
4. What follows a segment matters only through the differences between the
   costs of its grammar states, which take a small closed set of values
   (``OUTLOOKS``). A segment therefore is a map on that set and a map on grammar
   states; conversations of several segments compose those maps in blocks
   (``scanned``), so none has to fit one task.

Defined results: null texts and roles are one space; null conversation ids are
one conversation; null turns come first; turns with the same number go by role
and then by a hash of the text; repeated rows are repeated turns; an empty
table gives empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from quillmart.llm.common import cut, ship

SEGMENT = 1024
BLOCK = 4096  # segments whose maps one task composes
CONV = ["none", "conv_id"]
DIGEST = "none boolean, conv_id long, cost long, audit string, repaired_sha256 string"

# Grammar states: at the start, after the system turn, after a user turn, after
# an assistant turn. A sound conversation ends at the start or after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEEDED = [USER, USER, ASSISTANT, USER]  # state that a rerole or an insert leads to
NAMES = {USER: "user", ASSISTANT: "assistant"}
BY_INITIAL = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
LETTERS = "DsuaxSUAX"  # must go; role initial (x: any other) of a turn; upper case: truncated
FAR = 10 ** 9

Node = tuple[tuple[int, ...], str]


def settle(options: list[list[tuple[int, str]]]) -> Node:
    """Cost and edit of each grammar state from its (cost, edit) options, when
    a turn may also be inserted."""
    best = [min(o, default=(FAR, "")) for o in options]
    for _ in range(3):  # an insert leads on to a state that may itself insert
        best = [min(b, (best[NEEDED[s]][0] + INSERT, "I")) for s, b in enumerate(best)]
    return tuple(c for c, _ in best), "".join(e or "-" for _, e in best)


def before(costs: tuple[int, ...], letter: str) -> Node:
    """The node of a suffix that begins with a turn, from the costs behind it."""
    options = []
    for s in range(4):
        found = [(DELETE + costs[s], "D")]
        if letter != "D":
            extra = TRUNCATED if letter.isupper() else 0
            kept = BY_INITIAL.get((s, letter.lower()))
            if kept is not None:
                found.append((extra + costs[kept], "K"))
            found.append((extra + REROLE + costs[NEEDED[s]], "R"))
        options.append(found)
    return settle(options)


END: Node = settle([[(0, "-")], [], [], [(0, "-")]])


def level(costs: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(c - min(costs) for c in costs)


def _outlooks() -> tuple[list[tuple[int, ...]], dict[str, np.ndarray]]:
    """All cost differences that can follow a turn, the end's first, and for
    each letter the map from the outlook behind a turn to the one before it."""
    seen = [level(END[0])]
    for costs in seen:
        for letter in LETTERS:
            if (found := level(before(costs, letter)[0])) not in seen:
                seen.append(found)
    return seen, {x: np.array([seen.index(level(before(c, x)[0])) for c in seen], np.int32) for x in LETTERS}


OUTLOOKS, OUTLOOK_BEFORE = _outlooks()


def walk(path: list[Node], word: str, state: int) -> tuple[str, int]:
    """Best edits along a path of nodes (the segment's end first) from a state,
    and the state behind the segment."""
    edits = []
    at = len(path) - 1
    while True:
        edit = path[at][1][state]
        if edit == "-":
            return "".join(edits), state
        edits.append(edit)
        if edit in "IR":
            state = NEEDED[state]
        elif edit == "K":
            state = BY_INITIAL[state, word[len(word) - at].lower()]
        if edit != "I":
            at -= 1


def repairs(words: DataFrame) -> DataFrame:
    """For each distinct (``word``, ``outlook``): the best audits (``edits``)
    from the four grammar states and the states behind (``exits``)."""
    ship(words.sparkSession)
    out = StructType.fromDDL("word string, outlook int, edits array<string>, exits array<int>")
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, nodes = (-1, ""), []
        for batch in batches:
            rows = []
            for tail, outlook in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if outlook != last[0]:
                    # Behind an inner segment nothing is decided yet; its own
                    # inserts belong to the node behind it.
                    nodes, shared = [END if outlook == 0 else (OUTLOOKS[outlook], "----")], 0
                else:
                    shared = next((i for i, (a, b) in enumerate(zip(last[1], tail)) if a != b), min(len(last[1]), len(tail)))
                del nodes[shared + 1:]
                for letter in tail[shared:]:
                    nodes.append(before(nodes[-1][0], letter))
                last, word = (outlook, tail), tail[::-1]
                found = [walk(nodes, word, s) for s in range(4)]
                rows.append((word, outlook, [e for e, _ in found], [s for _, s in found]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, arrow)], schema=arrow)

    tails = words.select(F.reverse("word").alias("tail"), "outlook").distinct()
    return tails.repartitionByRange("outlook", "tail").sortWithinPartitions("outlook", "tail").mapInArrow(run, out)


def scanned(df: DataFrame, key: list[str], place: str, step: str, start: int, value: str, block: int = BLOCK) -> DataFrame:
    """``df`` with ``value``: what ``start`` has become before each row, when
    the rows of a key are passed by ``place`` (numbered from 0) and each turns
    a value v into ``step[v]``. Blocks of rows are composed side by side; what
    one task holds of a key is a block, or one map per block."""
    spread = cut(df.withColumn("__b", F.floor(F.col(place) / block)))
    fields = {f.name: f.dataType.simpleString() for f in spread.schema}
    of_key = ", ".join(f"`{c}` {fields[c]}" for c in key)

    def passed(maps: pd.Series, at: int) -> tuple[list[int], int]:
        seen = []
        for m in maps:
            seen.append(at)
            at = int(m[at])
        return seen, at

    def compose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(place)
        whole = np.arange(len(rows[step].iloc[0]))
        for m in rows[step]:
            whole = np.asarray(m)[whole]
        return rows[[*key, "__b"]].head(1).assign(**{step: [whole.tolist()]})

    def at_blocks(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("__b")
        return rows[[*key, "__b"]].assign(__at=passed(rows[step], start)[0])

    def at_rows(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(place)
        return rows[[*key, place]].assign(**{value: passed(rows[step], int(rows["__at"].iloc[0]))[0]})

    small = spread.select(*key, "__b", place, step)
    maps = small.groupBy(*key, "__b").applyInPandas(compose, f"{of_key}, __b long, `{step}` array<int>")
    starts = maps.groupBy(*key).applyInPandas(at_blocks, f"{of_key}, __b long, __at int")
    values = small.join(starts, [*key, "__b"]).groupBy(*key, "__b").applyInPandas(
        at_rows, f"{of_key}, `{place}` {fields[place]}, `{value}` int")
    return spread.drop("__b").join(values, [*key, place])


class Repair:
    """The repair of all conversations of ``rows`` (conv_id, turn, role, text):
    ``edits`` has the edits of each conversation in order (``at``, ``n``) with the
    role and text that results (none for Delete); ``faults`` counts per conversation."""

    def __init__(self, rows: DataFrame, segment: int = SEGMENT, block: int = BLOCK):
        one_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
        turns = rows.select(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id"),
                            F.col("turn").cast("long").alias("turn"), one_space("role").alias("role"), one_space("text").alias("text"))
        turns = turns.withColumns({"k1": F.xxhash64("role", "text"), "k2": F.xxhash64("text", F.lit("|"), "role")})
        order = [*CONV, "turn", "role", "k1", "k2"]
        self.turns = cut(turns.repartitionByRange(*order).sortWithinPartitions(*order)).withColumns(
            {"place": F.monotonically_increasing_id(), "part": F.spark_partition_id()})
        self.segments = cut(self._segments(self._letters(), segment))
        self.repaired = self._repaired(block)

    def _letters(self) -> DataFrame:
        blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
        firsts = self.turns.where(~blank).groupBy(*CONV, "k1", "k2").agg(F.min("place").alias("place"))
        initial = F.substring("role", 1, 1)
        seen = self.turns.select("place", "part", *CONV, F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
                                 blank.alias("blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut_off"))
        fault = F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("cut_off"), "t").otherwise(".")
        return seen.join(firsts.select("place", F.lit(True).alias("first")), "place", "left").withColumn("fault", fault)

    @staticmethod
    def _segments(letters: DataFrame, segment: int) -> DataFrame:
        """Runs of at most ``segment`` turns of one conversation in one
        partition, numbered (``n`` of ``of``) within the conversation."""
        idx = F.row_number().over(Window.partitionBy("part", *CONV).orderBy("place")) - 1
        runs = letters.withColumn("run", F.floor(idx / segment)).groupBy("part", *CONV, "run").agg(
            F.array_sort(F.collect_list(F.struct("place", "initial", "fault"))).alias("t"))
        joined = lambda f: F.array_join(F.transform("t", f), "")
        signature = lambda t: F.when(t["fault"].isin("b", "d"), "D").when(t["fault"] == "t", F.upper(t["initial"])).otherwise(t["initial"])
        runs = runs.select(*CONV, F.col("t.place").alias("places"), joined(signature).alias("word"), joined(lambda t: t["initial"]).alias("roles"),
                           joined(lambda t: t["fault"]).alias("marks"), F.col("t.place")[0].alias("at"))
        by = Window.partitionBy(*CONV).orderBy("at")
        return runs.withColumns({"n": (F.row_number().over(by) - 1).cast("long"), "role_before": F.substring(F.lag("roles").over(by), -1, 1)})

    def _repaired(self, block: int) -> DataFrame:
        """Segments with the best audit and the grammar state it starts in."""
        s = self.segments
        counts = s.groupBy(*CONV).agg(F.count("*").alias("of"))
        whole = s.join(counts.where("of = 1").select(*CONV), CONV).withColumns({"outlook": F.lit(0), "state": F.lit(START)})
        several = s.join(counts.where("of > 1"), CONV)
        several = several.withColumn("back", F.col("of") - 1 - F.col("n")).drop("of")
        several = scanned(several.mapInPandas(_with_outlook_map, StructType([*several.schema, StructField("map", ArrayType(IntegerType()))])), CONV, "back", "map", 0, "outlook", block)
        several = cut(several.drop("map", "back"))
        found = cut(repairs(whole.select("word", "outlook").unionByName(several.select("word", "outlook"))))
        several = scanned(several.join(found.select("word", "outlook", F.col("exits").alias("map")), ["word", "outlook"]),
                          CONV, "n", "map", START, "state", block).drop("map")
        return (whole.unionByName(several).join(found, ["word", "outlook"])
                .withColumn("audit", F.col("edits")[F.col("state")]).drop("edits", "exits"))

    @property
    def edits(self) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    state, i = r["state"], 0
                    for n, edit in enumerate(r["audit"]):
                        to = NEEDED[state] if edit in "IR" else None
                        place = None if edit == "I" else r["places"][i]
                        rows.append((r["none"], r["conv_id"], r["at"], n, edit, place, NAMES.get(to), edit in "KR" and r["word"][i].isupper()))
                        state = to if to is not None else state if edit == "D" else BY_INITIAL[state, r["word"][i].lower()]
                        i += edit != "I"
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 8, arrow)], schema=arrow)

        out = StructType.fromDDL("none boolean, conv_id long, `at` long, n long, edit string, place long, to string, cut_off boolean")
        arrow = to_arrow_schema(out)
        ship(self.turns.sparkSession)
        made = self.repaired.select(*CONV, "at", "word", "places", "audit", "state").mapInArrow(run, out)
        cost = (F.when(F.col("edit") == "D", DELETE).when(F.col("edit") == "K", 0).otherwise(INSERT)
                + F.when(F.col("cut_off"), TRUNCATED).otherwise(0)).cast("long").alias("cost")
        head = [*CONV, "at", "n", "edit", cost]
        inserted = made.where("edit = 'I'").select(*head, F.col("to").alias("role"), F.lit("").alias("text"))
        gone = made.where("edit = 'D'").select(*head, F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
        stays = made.where("edit IN ('K', 'R')").join(self.turns.select("place", "role", "text"), "place").select(
            *head, F.coalesce("to", "role").alias("role"), "text")
        return inserted.unionByName(gone).unionByName(stays)

    @property
    def faults(self) -> DataFrame:
        """Per conversation: missing turn numbers, faults, and neighbours whose
        roles don't follow each other."""
        count = lambda c, mark: F.sum(F.length(F.regexp_replace(c, f"[^{mark}]", ""))).cast("long")
        pairs = F.concat(F.coalesce("role_before", F.lit("")), "roles")
        wrong = F.size(F.filter(F.sequence(F.lit(1), F.length("p")), lambda i: (i < F.length("p")) & ~F.substring("p", i, F.lit(2)).isin("su", "ua", "au")))
        of_runs = self.segments.withColumn("p", pairs).groupBy(*CONV).agg(
            count("marks", "b").alias("blank"), count("marks", "d").alias("duplicate"), count("marks", "t").alias("truncated"),
            F.sum(wrong).cast("long").alias("illegal"))
        gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
        return self.turns.groupBy(*CONV).agg(gaps.alias("gaps")).join(of_runs, CONV)


def _with_outlook_map(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds each segment's map from the outlook behind it to the one before."""
    for rows in batches:
        maps = []
        for word in rows["word"]:
            at = np.arange(len(OUTLOOKS))
            for letter in reversed(word):
                at = OUTLOOK_BEFORE[letter][at]
            maps.append(at.tolist())
        yield rows.assign(map=maps)


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with faults set by crc32(``conv_id:turn``) modulo 20 (nulls:
    one space): 0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3
    repeats it, 4 makes it the user's."""
    one_space: dict[str, Column] = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat_ws(":", one_space["conv_id"], one_space["turn"])) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(one_space["text"], "[.!?]", "")).otherwise(one_space["text"])
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(one_space["role"]).alias("role"),
                                        text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def digests(edits: DataFrame) -> DataFrame:
    """Per conversation (DIGEST): cost, audit, and the digest of the repaired
    ``role:text``, newline-joined. A digest is sequential by nature: the edits of
    a conversation stream in order through one task, which holds one row, the
    hash state and the audit."""
    ship(edits.sparkSession)
    out = StructType.fromDDL(DIGEST)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cost, audit, lines, state = None, 0, [], 0, None

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        for batch in batches:
            done = []
            for none, conv, edit, price, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (none, conv) != now:
                    if now is not None:
                        done.append((*now, cost, "".join(audit), state.hexdigest()))
                    now, cost, audit, lines, state = (none, conv), 0, [], 0, hashlib.sha256()
                cost += price
                audit.append(edit)
                if edit != "D":
                    state.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
            if done:
                yield batch_of(done)
        if now is not None:
            yield batch_of([(*now, cost, "".join(audit), state.hexdigest())])

    ordered = edits.repartition(*CONV).sortWithinPartitions(*CONV, "at", "n")
    return ordered.select(*CONV, "edit", "cost", "role", "text").mapInArrow(run, out)
