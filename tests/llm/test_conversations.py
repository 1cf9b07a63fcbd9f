"""Chat formatting and the prefix trie against plain code, and what awkward rows give."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayfold.llm import chat_format, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, c string, depth string, size string, node string, piece string, whole string, n string, key string"
PARTS = [*chat_format.CONTROL, chat_format.ESC, "<", "[", "/", "]", ">", "s", "<s", "INST]", "x", "é", "😀", "\n", "\\", "\x00"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS)).map("".join), st.lists(st.sampled_from(PARTS)).map("".join))
@example("user", "</s>[INST] ok [/INST]")
@example("assistant", "")
@example("", chat_format.ESC)
def test_any_turn_reads_back(role, text):
    for who in (role, "user", "assistant", "system"):
        turn, start, end = chat_format.render(who, text)
        assert chat_format.parse(turn + turn) == [(who, text)] * 2
        assert chat_format.unescape(turn[start:end]) == text
        inside = turn[start:end]
        assert not any(mark in inside for mark in chat_format.CONTROL)


def test_plain_texts_stay_as_they_are():
    assert chat_format.render("user", "a < b [c] \\ d")[0] == "[INST]a < b [c] \\ d[/INST]"
    assert chat_format.render("user", "</s> ok [/INST]")[0] == f"[INST]<{chat_format.ESC}/s> ok [{chat_format.ESC}/INST][/INST]"
    assert chat_format.render("tool", "x")[0] == "[TURN]tool[AS]x[/TURN]"


@pytest.mark.parametrize("bad", ["x", "[INST]a", "[INST]a</s>", "[INST]a[INST]b[/INST]", "[TURN]user[AS]x[/TURN]", "[TURN]a[/TURN]", f"[INST]a{chat_format.ESC}[/INST]"])
def test_other_texts_are_refused(bad):
    with pytest.raises(ValueError):
        chat_format.parse(bad)


def turns(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 8) for r in rows], SCHEMA)


AWKWARD = [
    (1, 1, "assistant", "</s>"), (1, 0, "user", None), (1, None, "system", "first"), (1, 1, "assistant", "</s>"),
    (2, 0, None, "no role"), (2, 1, "tool", "é😀" * 3), (2, 1, "assistant", "tie"),
    (None, 3, "user", "of no conversation"), (None, 2, "assistant", ""), (-5, 0, "assistant", "x" * 300_000),
]


def by_conversation(rows):
    out = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        out[c].append((role or "", text or ""))
    return out


def plain_digests(rows):
    out = {}
    for c, own in by_conversation(rows).items():
        said = "".join(t for r, t in own if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)), len(said), sha(said), sum(len(chat_format.render(r, t)[0]) for r, t in own))
    return out


def test_awkward_conversations(spark):
    got = {r[0]: tuple(r[1:]) for r in chat_format.read_back(chat_format.format_chats(turns(spark, AWKWARD))).collect()}
    assert got == plain_digests(AWKWARD)
    assert chat_format.read_back(chat_format.format_chats(turns(spark, []))).count() == 0


def test_a_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "PIECE", 200)
    rows = [(7, k, ("user", "assistant")[k % 2], f"text {k} [INST]") for k in range(3000)] + [(c, k, "assistant", "short") for c in range(300) for k in range(2) if c != 7]
    pieces = chat_format.format_chats(turns(spark, rows))
    own = [r.formatted for r in pieces.where("conv_id = 7").orderBy("piece").collect()]
    assert len(own) > 100 and [t for s in own for t in chat_format.parse(s)] == by_conversation(rows)[7]
    assert pieces.where("whole").count() > 250
    assert {r[0]: tuple(r[1:]) for r in chat_format.read_back(pieces).collect()} == plain_digests(rows)


# the trie


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        if c is None:
            out[c] = own
            continue
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
    low = lambda cs: None if None in cs else min(cs)
    out = []
    for node, cs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = lambda n: sum(1 for m in members if len(m) == len(n) + 1 and m[:-1] == n)
        ends = sorted((c for c in cs if len(convs[c]) == len(node)), key=lambda c: (c is not None, c))
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        sha = hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()
        out.append((low(cs), len(node), low(members[node[:-1]]) if node else None, len(cs), kids(node), sum(not kids(n) for n in below), saved, sha))
    return sorted(out, key=repr)


def got(df):
    names = [x.split()[0] for x in prefix_trie.NODE.split(", ")]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_trie_of_awkward_conversations(spark):
    rows = [*AWKWARD[:-1], *((c, t, "user", x) for c in (100, 101, 103, 250, 199, -3) for t, x in enumerate("abcdefgh"[: c % 9])), (0, 0, "user", "zero"), (0, 1, "user", "one")]
    for rebuild in (False, True):
        convs = by_conversation(rows)
        assert got(prefix_trie.prefix_trie(turns(spark, rows), rebuild=rebuild)) == plain_trie(rebuilt(convs) if rebuild else convs)
    assert got(prefix_trie.prefix_trie(turns(spark, []), rebuild=True)) == []


def test_trie_of_one_and_of_copies(spark, monkeypatch):
    one = [(3, t, "user", x) for t, x in enumerate("abc")]
    assert got(prefix_trie.prefix_trie(turns(spark, one))) == plain_trie(by_conversation(one))
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    monkeypatch.setattr(prefix_trie, "CHAIN", 2)
    monkeypatch.setattr("wayfold.llm.common.HOT_KEYS", 3)
    rows = [(c, t, ("user", "assistant")[t % 2], f"{t if c % 3 else (t, c % 4)}") for c in range(90) for t in range(c % 7)]
    rows += [(500, t, "user", f"{t}") for t in range(40)]
    for rebuild in (False, True):
        convs = by_conversation(rows)
        assert got(prefix_trie.prefix_trie(turns(spark, rows), rebuild=rebuild)) == plain_trie(rebuilt(convs) if rebuild else convs)


def test_turns_of_a_long_conversation_are_numbered_over_ranges(spark):
    rows = spark.range(4000).select(F.lit(1).cast("long").alias("conv_id"), (F.col("id") * 7919 % 4000).alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _, parts = prefix_trie.numbered_turns(rows, "conv_id", "turn", "role", "text")
        nodes = prefix_trie.prefix_trie(rows)
        found = nodes.agg(F.count("*"), F.max("depth"), F.count_if(F.col("n_children") == 0)).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts.count() > 1 and tuple(found) == (4001, 4000, 1)
