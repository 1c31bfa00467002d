"""Chat formatting: exact round trips, masks, long conversations and edge cases."""

import hashlib
import random

from occurlens.llm import chat
from occurlens.llm.queries import CHAT_TOKENIZER

SCHEMA = "conv_id long, turn long, role string, text string"


def want(turns):
    learnt = [t or "" for r, t in turns if r == "assistant"]
    text = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    return (len(turns), hashlib.sha256(text.encode()).hexdigest(), sum(map(len, learnt)),
            hashlib.sha256("".join(learnt).encode()).hexdigest())


def test_escape_round_trip():
    rng = random.Random(2)
    for _ in range(500):
        s = "".join(rng.choice(["<", "|", "\\", ">", "a", "é", "\n", "<|im_end|>", "👩‍👧"]) for _ in range(rng.randint(0, 12)))
        assert chat.unescape(chat.escape(s)) == s and "<|" not in chat.escape(s)


def test_noise_conversations(spark, monkeypatch):
    rng = random.Random(1)
    bits = ["<|im_end|>", "<|im_start|>", "<|im_sep|>", "<|endoftext|>", " ", "\n", "\\", "word", " é漢", "👩‍👧", "<", "|>", "  x"]
    convs = {c: [(rng.choice(["user", "assistant", "system", "assistant"]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 9))))
                 for _ in range(rng.randint(1, 6))] for c in range(150)}
    convs[900] = [("assistant", f"turn {i} <|im_end|>") for i in range(1300)]  # several segments
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as segment", "1 as part")
    got = {r.conv_id: r for r in chat.table(df, CHAT_TOKENIZER).collect()}
    assert set(got) == {*convs, -1}
    for c, turns in convs.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want(turns), turns
    out = chat.format_conversations(df, CHAT_TOKENIZER).filter("conv_id < 5").collect()
    assert all(len(r.ids) == len(r.loss) == len(r.starts) and r.ends[-1] == len(r.formatted) for r in out)


def test_ties_nulls_repeats_and_empty(spark):
    rows = [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 2, "assistant", "x")]
    got = {r.conv_id: r for r in chat.digest(chat.format_conversations(spark.createDataFrame(rows, SCHEMA), CHAT_TOKENIZER)).collect()}
    assert got[1].turns_sha256 == want([(None, None), ("user", "a"), ("user", "a"), ("user", "b")])[1]
    assert got[None].loss_chars == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.digest(chat.format_conversations(empty, CHAT_TOKENIZER)).count() == 0
    assert [r.conv_id for r in chat.table(empty, CHAT_TOKENIZER).collect()] == [-1]


def test_token_columns_agree_with_the_mask_runs(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate([("user", "hi there"), ("assistant", "one <| two\\"), ("assistant", " é漢 "), ("user", "")])]
    df = spark.createDataFrame(rows, SCHEMA)
    (r,) = chat.format_conversations(df, CHAT_TOKENIZER).collect()
    covered = {p for a, b, x in zip(r.starts, r.ends, r.loss) if x for p in range(a, b)}
    assert covered == {p for a, b in zip(r.loss_starts, r.loss_ends) for p in range(a, b)}
    assert chat.read_loss(r.formatted, r.loss_starts, r.loss_ends) == "one <| two\\ é漢 "
    (slim,) = chat.format_conversations(df, CHAT_TOKENIZER, tokens=False).collect()
    assert "ids" not in slim and (slim.formatted, slim.loss_starts) == (r.formatted, r.loss_starts)
