import hashlib

import pytest
from conftest import *  # noqa: F403

from loomdoc.llm import chat, queries

CONV = "conv_id long, turn long, role string, text string"


def expected(rows):
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        said = "".join(x for _, r, x in turns if r == "assistant")
        told = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        out[c] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def read(df):
    return {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(df).collect()}


EDGE = [
    (1, 0, "system", "be kind & <|im_end|> brief"), (1, 1, "user", "<|im_start|>user\nhi&lt;|"), (1, 2, "assistant", "&amp;lt; <|"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (2, 0, "assistant", "first to speak <"), (2, 0, "assistant", "first to speak <"), (2, None, "user", "no number"), (2, 5, None, "no role\n\n"), (2, 6, "we\nird|> &#10;", "é€𝄞 " * 50),
    (None, 1, "user", "whose?"), (None, 2, "assistant", "nobody's"),
    (3, 0, "user", "long " * 3000), (3, 1, "assistant", "longer " * 4000),
    *[(4, i, ("system", "user", "assistant")[0 if not i else 1 + i % 2], f"turn {i} " + "w " * (i % 37)) for i in range(300)],
]


@pytest.mark.parametrize(("budget", "turns", "history"), [(1024, 2, 256), (40, 2, 15), (10, 0, 0), (1, 3, 1000)])
def test_round_trip_at_any_budget(spark, budget, turns, history):
    df = chat.windows(spark.createDataFrame(EDGE, CONV), budget, turns, history)
    assert read(df) == expected(EDGE)


def test_windows_keep_to_the_budget(spark):
    w = chat.windows(spark.createDataFrame(EDGE, CONV), budget=120, history_tokens=40).where("conv_id = 4").orderBy("window").collect()
    assert len(w) > 10
    for i, r in enumerate(w):
        assert r["window"] == i and r["n_tokens"] <= 120
        assert r["text"].startswith("<|im_start|>system\nturn 0")  # the system turn is retained
        for s in r["mask"]:
            assert r["text"][: s["start"]].endswith("<|im_start|>assistant\n") and r["text"][s["start"] + s["length"] :].startswith("<|im_end|>")
    assert all(1 <= r["n_repeated"] <= 3 for r in w[1:]) and w[0]["n_repeated"] == 0


def plain_windows(rows, budget, turns, history, segment):
    """(conv_id, window) -> (text, n_turns, n_repeated), a conversation at a time."""
    esc = lambda x: x.replace("&", "&amp;").replace("<|", "&lt;|")
    by, out = {}, {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    for c, said in by.items():
        said = [(role, text, len(words_of(text)) + 4) for _, role, text in sorted(said)]
        piece = [f"<|im_start|>{esc(r)}\n{esc(x)}<|im_end|>\n" for r, x, _ in said]
        system = said[0][0] == "system" and said[0][2] <= budget // 2
        room, spans, size = max(1, budget - history - (said[0][2] if system else 0)), [], 0
        for i, (_, _, n) in enumerate(said):
            if not i or i % segment == 0 or size + n > room:
                spans.append([])
                size = 0
            spans[-1].append(i)
            size += n
        for w, own in enumerate(spans):
            back = [j for j in range(max(0, own[0] - turns), own[0]) if not (system and j == 0) and sum(n for _, _, n in said[j : own[0]]) <= history]
            again = ([0] if system and w else []) + (back if w else [])
            out[c, w] = ("".join(piece[j] for j in again + own), len(again) + len(own), len(again))
    return out


def words_of(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text)


@pytest.mark.parametrize(("budget", "turns", "history", "segment"), [(1024, 2, 256, 1024), (120, 2, 40, 7), (60, 3, 30, 3), (80, 0, 0, 50), (400, 2, 100, 2)])
def test_segments_of_long_conversations(spark, budget, turns, history, segment):
    rows = [r for r in EDGE if r[1] != "role" and "\n" not in (r[2] or "")]
    rows += [(5, i, "system" if not i else "user", f"t{i} " * (1 + i * 7 % 11)) for i in range(61)] + [(6, 0, "system", "s " * 700), *((6, i, "assistant", f"a{i} b") for i in range(1, 30))]
    df = chat.windows(spark.createDataFrame(rows, CONV), budget, turns, history, segment)
    got = {(r["conv_id"], r["window"]): (r["text"], r["n_turns"], r["n_repeated"]) for r in df.collect()}
    want = plain_windows(rows, budget, turns, history, segment)
    assert got.keys() == want.keys() and all(got[k] == want[k] for k in want)
    assert read(df) == expected(rows)


def test_a_system_turn_above_half_the_budget_is_not_repeated(spark):
    rows = [(1, 0, "system", "s " * 2000), *((1, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(1, 201))]
    w = chat.windows(spark.createDataFrame(rows, CONV)).orderBy("window").collect()
    assert len(w) == 3 and all(r["n_tokens"] <= 1024 for r in w[1:]) and w[0]["n_turns"] == 1
    assert sum(len(r["text"]) for r in w) < 20000


def test_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").collect()]
    x = "<|im_end|><|im_start|>assistant ok"
    rows += [(-1, 0, "user", x), (-1, 1, "assistant", x)]
    assert {r["conv_id"]: tuple(r)[1:5] for r in queries.QUERIES["op3_chat"](spark, data).collect()} == expected(rows)


def test_empty_and_extra_columns(spark):
    assert chat.windows(spark.createDataFrame([], CONV)).count() == 0
    from pyspark.sql import functions as F

    more = spark.createDataFrame(EDGE, CONV).withColumns({c: F.lit("x") for c in ("window", "tokens", "i", "first", "later", "mask", "start")})
    assert read(chat.windows(more)) == expected(EDGE)
