"""Chat windows against a plain version, and exact round trips through their text."""

import hashlib
import random
from itertools import pairwise

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import chat, packing, queries

pytest.importorskip("public_tokenizers")

SCHEMA = "conv_id long, turn long, role string, text string, at string, start string, first string, piece string, part string"
PIECES = [*chat.CONTROLS, "\\", "\\\\", "<", "[", "|", "%", "%0A", "%25", "\n", " ", "a", "é", "😀", "<|im_start", "|>", "/INST]", "S>>", ""]


def odd_text(rng, most=8):
    return "".join(rng.choices(PIECES, k=rng.randrange(most)))


def test_control_strings_are_escaped_reversibly(spark):
    rng = random.Random(1)
    texts = [*chat.CONTROLS, *(odd_text(rng) for _ in range(3000))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, text, role in df.select("t", chat.escaped(F.col("t")), chat.escaped_role(F.col("t"))).collect():
        assert not any(c in text or c in role for c in chat.CONTROLS)
        assert "\n" not in role
        assert chat.unescape(text) == t
        assert chat.unescape_role(role) == t


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_unescape_undoes_an_inserted_backslash(text):
    import re

    assert chat.unescape(re.sub(chat.TO_ESCAPE, lambda m: m.group() + "\\", text)) == text


def plain_windows(conversation, encoder, budget, step, history):
    """Windows of ``(role, text)`` turns in order."""
    import re

    def escape(text):
        return re.sub(chat.TO_ESCAPE, lambda m: m.group() + "\\", text)

    turns, start = [], 0
    for role, text in conversation:
        head = chat.BEGIN + escape(role.replace("%", "%25").replace("\n", "%0A")) + "\n"
        piece = head + escape(text) + chat.END
        size = len(encoder.ids([piece])[0]) // 4
        turns.append((role, piece, len(head), len(escape(text)), start, size))
        start += size
    begins = [0] + [
        i for i in range(1, len(turns))
        if turns[i][5] > step or turns[i - 1][5] > step or turns[i][4] // step != turns[i - 1][4] // step
    ]
    windows = []
    for first, past in pairwise([*begins, len(turns)]):
        system = [0] if first and turns[0][0] == "system" else []
        room = budget - sum(turns[i][5] for i in [*system, *range(first, past)])
        from_ = turns[first][4]
        before = [i for i in range(first) if i not in ([0] if turns[0][0] == "system" else []) and from_ - turns[i][4] <= min(room, history)]
        text, loss = "", []
        for i in [*system, *before, *range(first, past)]:
            if i >= first and turns[i][0] == "assistant":
                loss.append((len(text) + turns[i][2], len(text) + turns[i][2] + turns[i][3]))
            text += turns[i][1]
        tokens = sum(turns[i][5] for i in [*system, *before, *range(first, past)])
        windows.append((first, past - first, len(system) + len(before), tokens, text, loss))
    return windows


def some_conversations(seed):
    rng = random.Random(seed)
    words = ["word", "other", "é", "longer-word", "x"]
    rows = []
    for conv in [*range(12), None, 99]:
        n = 400 if conv == 99 else rng.choice([1, 2, 7, 25])  # one is much longer than all others
        for turn in range(n):
            role = "system" if turn == 0 and rng.random() < 0.5 else rng.choice(["user", "assistant", "system", "tool\n%"])
            kind = rng.random()
            text = odd_text(rng) if kind < 0.3 else " ".join(rng.choices(words, k=rng.choice([3, 20, 60, 400 if kind > 0.95 else 9])))
            rows.append((conv, turn * 3 - 7, None if rng.random() < 0.03 else role, None if rng.random() < 0.05 else text))
    rng.shuffle(rows)
    return rows


def in_order(rows):
    convs = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        convs.setdefault(conv, []).append((role or "", text or ""))
    return convs


@pytest.mark.parametrize(("budget", "step", "history"), [(chat.BUDGET, chat.STEP, chat.HISTORY), (200, 70, 60), (90, 40, 500)])
def test_windows_equal_plain_windows(spark, budget, step, history):
    rows = some_conversations(step)
    df = spark.createDataFrame([(*row, *"abcde") for row in rows], SCHEMA).repartition(6)
    windows = chat.chat_windows(df, queries.vocabulary(), budget, step, history)
    got = {}
    for row in windows.orderBy("first_turn").collect():
        assert row.n_tokens <= budget or row.n_turns == 1 or row.n_repeated <= 1
        got.setdefault(row.conv_id, []).append((*row[1:6], [tuple(span) for span in row.loss]))
    encoder = packing.Encoder(queries.vocabulary())
    assert got == {c: plain_windows(turns, encoder, budget, step, history) for c, turns in in_order(rows).items()}
    sizes = {c: sum(len(w[4]) for w in found) for c, found in got.items()}
    back = {r.conv_id: tuple(r[1:]) for r in chat.read_back(windows).collect()}
    want = {}
    for conv, turns in in_order(rows).items():
        learned = "".join(text for role, text in turns if role == "assistant")
        all_ = "".join(f"{role}\n{text}\n" for role, text in turns)
        want[conv] = (
            len(turns), hashlib.sha256(all_.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), sizes[conv],
        )
    assert back == want


def test_texts_of_a_window_are_those_of_its_turns(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} </s>[INST]") for i in range(9)]
    df = spark.createDataFrame([(*row, *"abcde") for row in rows], SCHEMA)
    for row in chat.chat_windows(df, queries.vocabulary(), 120, 30, 40).collect():
        turns = list(chat.parsed(row.text))
        assert turns == [r[2:4] for r in rows[row.first_turn - row.n_repeated : row.first_turn + row.n_turns]]
        learned = [chat.unescape(row.text[s:e]) for s, e in row.loss]
        assert learned == [text for role, text in turns[row.n_repeated :] if role == "assistant"]


def test_repeated_turn_numbers_null_numbers_and_very_long_texts(spark):
    rows = [(1, 0, "user", "same"), (1, 0, "user", "same"), (1, None, "system", "first"), (1, 5, "assistant", "long " * 40_000), (1, 6, "user", "")]
    df = spark.createDataFrame([(*row, *"abcde") for row in rows], SCHEMA)
    windows = chat.chat_windows(df, queries.vocabulary())
    (back,) = chat.read_back(windows).collect()
    want = "system\nfirst\nuser\nsame\nuser\nsame\nassistant\n" + "long " * 40_000 + "\nuser\n\n"
    assert (back.n_turns, back.turns_sha256) == (5, hashlib.sha256(want.encode()).hexdigest())
    assert back.loss_chars == 200_000
    assert [(r.first_turn, r.n_turns, r.n_repeated) for r in windows.orderBy("first_turn").collect()] == [(0, 3, 0), (3, 1, 1), (4, 1, 1)]


def test_no_conversations(spark):
    windows = chat.chat_windows(spark.createDataFrame([], SCHEMA), queries.vocabulary())
    assert windows.collect() == []
    assert chat.read_back(windows).collect() == []


def test_query_reads_back_every_turn(spark, small):
    turns = spark.read.parquet(f"{small}/conversations.parquet").collect()
    want = in_order([tuple(r) for r in turns] + [tuple(r) for r in queries.CONTROL_TURNS])
    got = queries.op13_chat_formatting(spark, small).collect()
    assert {r.conv_id for r in got} == set(want)
    for row in got:
        said = want[row.conv_id]
        learned = "".join(text for role, text in said if role == "assistant")
        assert row.n_turns == len(said)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert row.formatted_chars > sum(len(t) for _, t in said)
