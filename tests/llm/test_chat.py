import hashlib
import re

import pytest

from campanile.llm import chat

ROWS = "conv_id long, turn long, role string, text string, pos long, span string"
NASTY = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>", "<\\|end|>", "[\\\\INST]", "<<SYS>>a<</SYS>>", "a < b | c [x] \\", "<|", "<\\\\|x<s><<s>", "$1\\1", "ünï\n"]


def convs():
    out = [(1, 0, "system", "be good"), (1, 1, "user", "a " * 300), (1, 2, "assistant", "b " * 900), (1, 3, "user", "c"), (1, 4, "assistant", "d " * 40)]
    out += [(2, k, ("user", "assistant")[k % 2], NASTY[k % len(NASTY)] * (k + 1)) for k in range(40)]
    out += [(3, 0, None, None), (3, None, "assistant", None), (4, 0, "assistant", "x"), (4, 0, "assistant", "x"), (None, 0, "user", "hm"), (5, 0, "system", "only"), (6, 0, "to<|ol", "<|")]
    out += [(7, 0, "system", "s " * 50)] + [(7, k, ("user", "assistant")[k % 2], f"t{k} " * 20) for k in range(1, 400)]
    return out


def make(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], ROWS)


def grouped(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(ts)] for c, ts in out.items()}


def test_read_back_is_what_went_in(spark):
    expected = grouped(convs())
    got = chat.read_back(chat.format_windows(make(spark, convs()))).collect()
    assert len(got) == len(expected)
    for r in got:
        assert [(t.role, t.text) for t in r.turns] == expected[r.conv_id]
        assert r.target == "".join(t for role, t in expected[r.conv_id] if role == "assistant")


def pieces(text):
    import regex

    return len(regex.findall(r"\p{L}{1,8}|\p{N}{1,3}|[^\p{L}\p{N}\x20\x09-\x0D]", text))


def test_windows(spark):
    windows = chat.format_windows(make(spark, convs()), budget=512, history_turns=2, history_tokens=128).collect()
    sevens = sorted((w for w in windows if w.conv_id == 7), key=lambda w: w.window)
    assert len(sevens) > 10
    for w in sevens:
        assert pieces(w.text) <= 512 and w.text.startswith("<|turn|>system<|text|>s s ")
        assert (w.repeated >= 2) == (w is not sevens[0])
        for s in w.loss_spans:
            assert re.fullmatch(r"(t\d+ )+", w.text[s.start : s.start + s.length])
    ones = [w for w in windows if w.conv_id == 1]
    assert all(pieces(w.text) <= 512 or w.text.count("<|turn|>") <= 2 + 2 for w in ones)


def test_a_turn_over_the_budget_stands_alone_and_whole(spark):
    rows = [(1, 0, "system", "be good"), (1, 1, "user", "a " * 30), (1, 2, "assistant", "b " * 5000), (1, 3, "user", "c " * 30), (1, 4, "assistant", "d")]
    windows = sorted(chat.format_windows(make(spark, rows)).collect(), key=lambda w: w.window)
    long = [w for w in windows if "b b " in w.text]
    assert len(long) == 1 and "b " * 5000 in long[0].text and "c c" not in long[0].text
    assert [long[0].text[s.start : s.start + s.length] for s in long[0].loss_spans] == ["b " * 5000]
    assert "a a " in long[0].text  # as history
    assert all(pieces(w.text) <= 512 for w in windows if w is not long[0])


def plain_windows(ts, budget, history_turns, history_tokens):
    """The windows of one conversation, by walking over its turns: lists of (turn's place, repeated?)."""
    size = [pieces(f"<|turn|>{r}<|text|>{t}<|end|>") for r, t in ts]
    system = size[0] if ts[0][0] == "system" else 0
    half = max(budget - system - history_tokens, 16) / 2
    first = 1 if system else 0
    window, at = {}, 0
    for i in range(first, len(ts)):
        window[i] = (at // half) * 2 + (size[i] > half)
        at += size[i]
    out = {}
    for i, w in window.items():
        if w not in out:
            old = [j for j in range(max(first, i - history_turns), i) if sum(size[j:i]) <= history_tokens]
            out[w] = ([(0, i != first)] if system else []) + [(j, True) for j in old]
        out[w].append((i, False))
    return [out[w] for w in sorted(out)] or [[(0, False)]]


@pytest.mark.parametrize(("budget", "turns", "tokens"), [(512, 2, 128), (100, 3, 60), (60, 0, 0), (90, 1, 20)])
def test_windows_equal_a_walk_over_the_turns(spark, budget, turns, tokens):
    """Over conversations whose turns' numbers jump, repeat and lie in many buckets, null ones among them."""
    import random

    rng = random.Random(budget)
    rows = []
    for conv in range(40):
        at = 0
        for _ in range(rng.choice([1, 2, 5, 60, 300])):
            at += rng.choice([0, 1, 1, 1, 40, 200])
            rows.append((conv if conv else None, at if rng.random() < 0.98 else None, rng.choice(["user", "assistant"]), " ".join(rng.choice(["word", "longerword", "12", "!"]) for _ in range(rng.choice([0, 3, 10, 40, 200])))))
        if conv % 3 == 0:
            rows.append((conv if conv else None, None, "", ""))
        if conv % 3 == 1:
            rows += [(conv, -5, "system", "sys " * rng.randint(0, 9))]
    expected = grouped(rows)
    found = {}
    for w in chat.format_windows(make(spark, rows), budget, turns, tokens).collect():
        found.setdefault(w.conv_id, []).append((w.window, w.text, w.repeated))
    assert set(found) == set(expected)
    for conv, ts in expected.items():
        got = [(text, repeated) for _, text, repeated in sorted(found[conv])]
        assert got == [("".join(f"<|turn|>{ts[i][0]}<|text|>{ts[i][1]}<|end|>" for i, _ in w), sum(r for _, r in w)) for w in plain_windows(ts, budget, turns, tokens)]


@pytest.mark.parametrize("text", NASTY)
def test_escape(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    escaped, back = df.select(chat.escape(df.t), chat.unescape(chat.escape(df.t))).first()
    assert back == text and not re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", escaped)


def test_empty(spark):
    assert chat.read_back(chat.format_windows(make(spark, []))).count() == 0


def test_conversation_minus_one_and_plan(spark):
    from campanile.llm.queries import QUERIES

    df = QUERIES["op4_chat"](spark, "/root/testdata/sf0.001")
    row = df.where("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert row.loss_chars == len(said) and row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert "Python" not in df._jdf.queryExecution().toString()
