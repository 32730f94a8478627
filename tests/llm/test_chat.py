"""Conversations as a prefix tree against trees built in memory, and read back from the output."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tallyflow.llm.bytelevel import token_bytes
from tallyflow.llm.chat import ChatTemplate, format_conversations, plain, read_conversations
from tallyflow.llm.queries import op11_chat_format, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
KIND = "conv_id long, turn long, role string, text string"
ODD = "\\### Assistant: </turn> ok"


def want(turns):
    """What is to be read back of one conversation's (role, text) pairs."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)), len(loss), sha(loss)


def conversations():
    shared = [("system", "be kind"), ("user", "hello")]
    out = {i: [*shared, ("assistant", f"answer {i % 4}"), ("user", "more" if i % 2 else None)] for i in range(12)}
    out |= {20: shared[:1], 21: shared, 22: shared, 23: [("user", ODD), ("assistant", ODD)], 24: [("a\nb</turn>", "\\n \\\\ <turn>x</turn"), (None, None), ("assistant", "<|endoftext|>\n</turn>\\")]}
    out |= {25: [("user" if i % 2 else "assistant", f"turn {i}") for i in range(300)], 26: [("user" if i % 2 else "assistant", f"turn {i}") for i in range(250)] + [("assistant", "else")], 27: [("assistant", "é " * 40_000)]}
    return out


@pytest.fixture(scope="module")
def chat(spark):
    rows = [(c, i, r, t) for c, turns in conversations().items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, KIND).withColumns({c: F.lit("clash") for c in ("segment", "key", "digest", "ids", "start", "no_c")}).repartition(5)
    return format_conversations(df, PATH)


def test_reads_back_every_conversation(chat):
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read_conversations(chat, PATH).collect()}
    assert got == {c: want(t) for c, t in conversations().items()}


def test_shared_turns_once_depth_first_with_positions_and_attention(chat):
    turns = [tuple((r or "", t or "") for r, t in x) for x in conversations().values()]
    prefixes = {t[: k + 1] for t in turns for k in range(len(t))}
    rows = chat.turns.orderBy("start").collect()
    assert len(rows) == len(prefixes)
    at, table, template = 0, token_bytes(PATH), ChatTemplate()
    segments = {r.segment: r for r in chat.segments.collect()}
    place: dict = {}  # prefix -> (start, tokens)
    path: list = []
    for r in rows:
        assert r.start == at and len(r.ids) == r.n_tokens
        at += r.n_tokens
        text = b"".join(table[i] for i in r.ids).decode()
        assert len(path) >= r.turn - 1  # depth first: a turn follows its parent's subtree
        path = [*path[: r.turn - 1], template.read(text)]
        prefix = tuple(path)
        assert prefix in prefixes and prefix not in place
        place[prefix] = (r.start, r.n_tokens)
        ancestors = [place[prefix[:k]] for k in range(1, len(prefix))]
        assert r.position == sum(n for _, n in ancestors)
        s = segments[r.segment]
        allowed = {x for a in s.ancestors for x in range(a.start, a.end)} | set(range(s.start, r.start))
        assert allowed == {x for b, n in ancestors for x in range(b, b + n)}
        assert s.tree == (ancestors[0][0] if ancestors else r.start)
    assert set(place) == prefixes
    assert len(segments) == len(set(turns))


def test_empty_ties_and_nulls(spark):
    empty = spark.createDataFrame([], KIND)
    chat = format_conversations(empty, PATH)
    assert chat.turns.count() == chat.segments.count() == chat.members.count() == read_conversations(chat, PATH).count() == 0
    rows = spark.createDataFrame([(None, 0, "user", "x"), (None, None, "user", "first"), (0, 1, "user", "b"), (0, 1, "user", "a"), (0, 1, "user", "a"), (5, 0, None, None)], KIND)
    got = {r.conv_id: r for r in read_conversations(format_conversations(rows, PATH), PATH).collect()}
    assert got[None].turns_sha256 == want([("user", "first"), ("user", "x")])[1]
    assert got[0].n_turns == 3 and got[5].turns_sha256 == want([(None, None)])[1] and len(got) == 3


def test_escapes():
    t = ChatTemplate()
    assert plain("\\\\n\\</turn>") == "\\n</turn>" and plain("a\\nb", "\n") == "a\nb"
    with pytest.raises(ValueError, match="formatted"):
        t.read("<turn>user\nopen </turn> end</turn>")


def test_query(spark):
    d = "/root/testdata/sf0.001"
    rows: dict = {}
    for r in spark.read.parquet(f"{d}/conversations.parquet").orderBy("conv_id", "turn").collect():
        rows.setdefault(r.conv_id, []).append((r.role, r.text))
    rows[-7] = [("user", ODD), ("assistant", ODD)]
    out = op11_chat_format(spark, d).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in out} == {c: want(t) for c, t in rows.items()} and len(out) == len(rows)
    odd = next(r for r in out if r.conv_id == -7)
    assert odd.formatted_chars == len("<turn>user\n</turn><turn>assistant\n</turn>") + 2 * (len(ODD) + 2)
