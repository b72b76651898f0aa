"""Chat windows: exact round trip, budgets, masks."""

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from tillcast.llm import chat_format as cf
from tillcast.llm.queries import QUERIES

DDL = "conv_id long, turn long, role string, text string, window int, loss string"
HARD = ["</s>[INST] ok [/INST]", "<|im_end|>\n", "a<", "<|im_start|>user\nhi<|im_end|>\n", "\\", "\\1\\0\\2", "\\[INST]", "<<SYS>>x<</SYS>>", "<|im_end|", "[", "", None, "日本 \U0001f600 <s>", "a\n\nb\n"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], DDL)


def expected(rows):
    out = {}
    for conv_id in {r[0] for r in rows}:
        turns = sorted((t, r or "", x or "") for c, t, r, x in rows if c == conv_id)
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[conv_id] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def round_trip(spark, rows, spec):
    windows = cf.windows(frame(spark, rows), spec).collect()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in cf.read_back(cf.windows(frame(spark, rows), spec)).collect()}
    assert {k: v[:4] for k, v in got.items()} == expected(rows)
    assert all(v[4] == sum(len(w.formatted) for w in windows if w.conv_id == k) for k, v in got.items())
    return windows


def test_hard_texts_and_roles(spark):
    rows = [(i, t, role, x) for i, x in enumerate(HARD) for t, role in enumerate(["system", "user", "assistant", "tool\nx<|", None])]
    rows += [(None, 3, "assistant", "null id"), (None, 1, "user", "q"), (50, 0, "assistant", "same"), (50, 0, "assistant", "same"), (51, 0, "system", "alone")]
    for spec in (cf.ChatSpec(), cf.ChatSpec(budget=3, history=1)):
        for w in round_trip(spark, rows, spec):
            assert w.formatted.count("<|im_end|>\n") == w.formatted.count("<|im_start|>")
            assert not any(c in w.formatted for c in ("</s>", "[INST]", "<<SYS>>"))


@pytest.mark.parametrize("seed", range(3))
def test_budgets_history_and_masks(spark, seed):
    draw = random.Random(seed)
    rows = []
    for c in range(12):
        if draw.random() < 0.6:
            rows.append((c, -1, "system", "s " * draw.randrange(1, 20)))
        rows += [(c, t, ("user", "assistant")[t % 2], f"t{c}x{t} " + "w " * draw.randrange(120)) for t in range(draw.randrange(1, 40))]
    spec = cf.ChatSpec(budget=200, history=60)
    by = {}
    for w in round_trip(spark, rows, spec):
        by.setdefault(w.conv_id, []).append(w)
    for conv_id, held in by.items():
        turns = [(r, x) for c, _, r, x in sorted(rows, key=lambda r: r[1]) if c == conv_id]
        has_system = turns[0][0] == "system"
        tokens = lambda x: len(x.split())
        place = 0
        for w in sorted(held, key=lambda w: w.window):
            shown = [s.removeprefix(cf.START).split("\n", 1) for s in w.formatted.split(cf.END)[:-1]]
            new = shown[w.repeated :]
            history = shown[has_system if place else 0 : w.repeated]
            assert [tuple(s) for s in new] == turns[place : place + len(new)]
            assert [tuple(s) for s in history] == turns[place - len(history) : place]
            assert sum(tokens(x) for _, x in history) <= spec.history
            if place and has_system:
                assert tuple(shown[0]) == turns[0]
            assert len(new) == 1 or sum(tokens(x) for _, x in shown) <= spec.budget
            place += len(new)
            assert [w.formatted[m.start - 1 : m.start - 1 + m.length] for m in w.loss] == [x for r, x in new if r == "assistant"]
        assert place == len(turns)


def test_long_conversation(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} " * 5) for t in range(1500)]
    assert len(round_trip(spark, rows, cf.ChatSpec())) > 20


def test_empty_table(spark):
    assert cf.read_back(cf.windows(frame(spark, []))).count() == 0


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(x,) for x in HARD if x is not None], "x string")
    assert df.where(cf.unescape(cf.escape(F.col("x"))) != F.col("x")).count() == 0


def test_query_holds_the_made_conversation(spark):
    sf = "/root/testdata/sf0.001"
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in turns.collect()] + [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in QUERIES["op9_chat_format"](spark, sf).collect()}
    assert got == expected(rows)


def as_tuples(windows):
    return sorted(((r.conv_id, r.window, r.repeated, r.formatted, [tuple(m) for m in r.loss]) for r in windows), key=str)


@pytest.mark.parametrize("budget, history", [(512, 128), (40, 15), (3, 0)])
def test_conversations_as_rows_give_the_same_windows(spark, monkeypatch, budget, history):
    monkeypatch.setattr(cf, "WIDE", 64)
    draw = random.Random(budget)
    rows = [(i, t, role, x) for i, x in enumerate(HARD) for t, role in enumerate(["system", "user", "assistant", "tool\nx<|", None])]
    rows += [(None, t, "assistant", f"null id {t % 3}") for t in range(30)] + [(60, None, "assistant", "" if t % 4 else "x") for t in range(40)] + [(51, 0, "system", "alone")]
    for c in range(100, 108):
        rows += [(c, -1, "system", "s " * draw.randrange(60))] * draw.randrange(2)
        rows += [(c, draw.randrange(30) if c % 2 else t, ("user", "assistant")[t % 2], "w " * draw.choice([0, 0, 1, 5, 30, 700])) for t in range(draw.randrange(1, 60))]
    short, long = (round_trip(spark, rows, cf.ChatSpec(budget, history, long_turns=n)) for n in (10**6, 0))
    assert as_tuples(short) == as_tuples(long)
    mixed = cf.windows(frame(spark, rows), cf.ChatSpec(budget, history, long_turns=20)).collect()
    assert as_tuples(mixed) == as_tuples(short)


def test_one_conversation_of_many_turns(spark):
    rows = [(1, -1, "system", "be brief")] + [(1, t, ("user", "assistant")[t % 2], f"turn {t} " * 20) for t in range(60_000)] + [(2, 0, "user", "hi")]
    begin = time.monotonic()
    assert len(round_trip(spark, rows, cf.ChatSpec())) > 4_000
    assert time.monotonic() - begin < 150
