import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from quillmart.llm import queries, structure_repair as sr
from quillmart.llm.structure_repair import CONV, Repair, damaged, digests
from tests.llm.conftest import SF, same

SOUND = re.compile(r"(s?(ua)+)?")


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        one = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults_of(turns):
    """Fault of each turn: b, d, t or a dot."""
    seen, out = set(), []
    for _, role, text in turns:
        bare = text.strip(" \t\n\v\f\r")
        out.append("b" if not bare else "d" if (role, text) in seen else "." if bare[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def cheapest(turns, faults):
    """(cost, audit, repaired) by forward search over all edit sequences: the
    dictionary keeps, per role initials seen so far reduced to a grammar
    state, the least (cost, audit)."""
    then = {"": "su", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(best):
        while True:
            more = dict(best)
            for state, (cost, audit, lines) in best.items():
                for to in then[state]:
                    if to != "s":
                        more[to] = min(more.get(to, (10 ** 9,)), (cost + 3, audit + "I", (*lines, f"{name[to]}:")))
            if more == best:
                return best
            best = more

    best = inserted({"": (0, "", ())})
    for (_, role, text), fault in zip(turns, faults):
        after = {}

        def offer(state, cost, audit, lines):
            after[state] = min(after.get(state, (10 ** 9,)), (cost, audit, lines))

        for state, (cost, audit, lines) in best.items():
            offer(state, cost + 4, audit + "D", lines)
            if fault in ".t":
                extra = 3 * (fault == "t")
                for to in then[state]:
                    if role[:1] == to:
                        offer(to, cost + extra, audit + "K", (*lines, f"{role}:{text}"))
                    if to != "s":
                        offer(to, cost + extra + 3, audit + "R", (*lines, f"{name[to]}:{text}"))
        best = inserted(after)
    return min(best[s] for s in ("", "a") if s in best)


def brute(rows, original):
    of = defaultdict(list)
    for conv, turn, role, text in rows:
        of[conv].append((turn, role, text))
    out = []
    for conv in original:
        turns = sorted(of[conv], key=lambda t: (t[0] is not None, t[0] or 0))
        if not turns:
            out.append((conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()))
            continue
        numbers = {t for t, *_ in turns if t is not None}
        faults = faults_of(turns)
        count = Counter(faults)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit, lines = cheapest(turns, faults)
        assert SOUND.fullmatch("".join(x[:1] for x in lines))
        out.append((conv, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, count["b"], count["d"], count["t"],
                    illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def rows_of(repair):
    found = repair.faults.join(digests(repair.edits), CONV).collect()
    return [(None if r["none"] else r["conv_id"], r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"],
             r["audit"], r["repaired_sha256"]) for r in found]


@pytest.fixture(scope="module")
def wild():
    """Conversations of 0 to 60 turns with every fault, one of them by far the
    longest, null ids, odd roles and null turns."""
    rng = random.Random(4)
    said = ["Yes.", "No!", "what", "", " \n ", "Why?", "x. ", "same.", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    out = []
    for conv in [None, *range(60)]:
        for turn in rng.sample(range(400), 300 if conv == 7 else rng.randrange(12)):
            text = rng.choice(said) if rng.random() < 0.5 else f"words {rng.random()}{rng.choice(['.', ''])}"
            out.append((conv, turn, rng.choice(roles), text))
    return out + [(99, None, "user", "no number."), (98, None, "system", "a."), (98, 3, "user", "b?")]


def test_repair_against_forward_search(spark, wild):
    one = lambda v: " " if v is None else v
    expected = brute([(c, t, one(r), one(x)) for c, t, r, x in wild], dict.fromkeys(c for c, *_ in wild))
    df = spark.createDataFrame(wild, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS place", "2 AS word", "3 AS at").repartition(6)
    same(rows_of(Repair(df)), expected)
    same(rows_of(Repair(df, segment=5, block=3)), expected)


def test_ties_repeats_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "a."), (1, 0, "user", "a."), (1, 1, "assistant", "b."), (2, 0, "user", ""), (3, 0, "assistant", "long " * 50_000 + ".")]
    got = {r[0]: r for r in rows_of(Repair(spark.createDataFrame(rows, schema).repartition(3)))}
    assert got[1][1:8] == (0, 0, 1, 0, 1, 4, "KDK") and got[2][6:8] == (4, "D") and got[3][6:8] == (3, "IK")
    assert rows_of(Repair(spark.createDataFrame([], schema))) == []


def test_outlooks_are_closed_and_nodes_shared(spark, monkeypatch):
    assert len(sr.OUTLOOKS) < 40
    words = ["ua" * 50 + tail for tail in ("", "u", "uD", "xa")] * 20
    df = spark.createDataFrame([(w, 0) for w in words], "word string, outlook int").coalesce(1)
    assert sr.repairs(df).count() == 4


def test_query_against_forward_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    same(found, brute_damage(rows))
    got = queries.op11_structure_repair(spark, SF)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    same(got.collect(), brute(brute_damage(rows), dict.fromkeys(r[0] for r in rows)))
