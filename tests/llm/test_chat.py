import hashlib
import random
from collections import defaultdict

import public_tokenizers
import pytest

from quillmart.llm import chat

BYTE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, first int, idx string, none int"


def digest(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


@pytest.fixture(scope="module")
def conversations(spark):
    rng = random.Random(4)
    odd = ["\\### Assistant: </turn> ok", "<|end|>\n<|turn 3|>user\nx", "a<", "\\", "\\n", "<\\|", "", None, "<|", "||<<||", "\n\n", "\u00e9\U0001f600"]
    rows = []
    for c in [None, 0, *range(1, 12)]:
        rows += [(c, 0, "system", "be brief")] if c and c % 2 else []
        for t in range(rng.randint(1, 9)):
            rows.append((c, t + 1, rng.choice(["user", "assistant"]), rng.choice(odd) if rng.random() < 0.5 else "word " * rng.randint(0, 400)))
    rows += [(50, None, "user", "no number"), (50, 1, None, "no role"), (50, 1, "as\\si\nstant", "odd role"), (51, 1, "assistant", "same"),
             (51, 1, "assistant", "same"), (52, 1, "assistant", "long " * 5000)]
    rows += [(60, t, "user" if t % 2 else "assistant", f"turn {t} of a long talk") for t in range(400)]
    return [(*r, 1, "x", 2) for r in rows]


def test_round_trip(spark, conversations):
    groups = defaultdict(list)
    for c, t, r, x, *_ in conversations:
        groups[c].append((t is not None, t, r or "", x or ""))
    expected = {c: digest([(r, x) for _, _, r, x in sorted(g, key=lambda v: (v[0], v[1] or 0, v[2], v[3]))]) for c, g in groups.items()}
    df = spark.createDataFrame(conversations, SCHEMA).repartition(6)
    formatted = chat.windows(df, BYTE, budget=256, history=2).cache()
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    assert {c: tuple(r[1:5]) for c, r in got.items()} == expected
    windows = formatted.collect()
    assert sum(w["conv_id"] == 60 for w in windows) > 20
    for w in windows:
        own = chat.read_window(w["text"])
        assert own and own[0][0] == w["first"]
        spent = w["n_tokens"]
        assert spent <= 256 or len(own) == 1  # only a single long turn exceeds the budget
        for s in w["loss"]:
            assert "<|" not in w["text"][s["start"]:s["end"]]
    # A later window starts with the system turn and at most two turns before its own.
    late = [w for w in windows if w["conv_id"] == 60 and w["first"] > 2][0]
    assert f"<|turn {late['first'] - 2}|>" in late["text"] and f"<|turn {late['first'] - 3}|>" not in late["text"]
    assert len(late["loss"]) == sum(r == "assistant" for _, r, _ in chat.read_window(late["text"]))
    with_system = [w for w in windows if w["conv_id"] == 1]
    assert all("be brief" in w["text"] for w in with_system)
    formatted.unpersist()


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.windows(df, BYTE)).count() == 0


def test_escaping():
    rng = random.Random(1)
    for _ in range(3000):
        t = "".join(rng.choice("\\<|n\nae>") for _ in range(rng.randint(0, 12)))
        assert chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t)
        role = t
        text, _ = chat.format_window(0, [(0, role, t), (1, "assistant", t)])
        assert chat.read_window(text) == [(0, role, t), (1, "assistant", t)]
