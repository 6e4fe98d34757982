import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import chat

LOG = "conv_id string, message long, seq long, kind string, role string, text string, conv string, part int"
tricky = st.text(st.sampled_from("\\#</turn>\n aé😀nassistant:"), max_size=40)


@given(tricky)
def test_escape_is_reversible_and_hides_control_strings(text):
    out, role = chat.escape(text), chat.escape_role(text)
    assert chat.unescape(out) == text and chat.unescape(role) == text
    assert "</turn>" not in out and "##" not in out and "\n" not in role


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a\nb:", "x: "]), tricky), max_size=6))
def test_part_round_trip(turns):
    part = chat._Part("assistant")
    for role, text in turns:
        part.add(role, text)
    read, learned = chat.read_back("".join(part.pieces), part.loss)
    assert read == turns
    assert learned == [t for r, t in turns if r == "assistant"]


def test_read_back_refuses_other_text():
    with pytest.raises(ValueError):
        chat.read_back("### user:\nhello", [])


def log_rows():
    e = []

    def add(conv, message, *events):
        for seq, (kind, role, text) in enumerate(events):
            e.append((conv, message, seq, kind, role, text, "clash", 1))

    add("c", 0, ("open", "user", None), ("delta", None, "Hel"), ("delta", None, "lo"))
    add("c", 1, ("open", "assistant", None), ("delta", None, "first"), ("regenerate", None, None),
        ("delta", None, "sec"), ("delta", None, "ond </turn>"))
    add("c", 2, ("open", "user", None), ("delta", None, "typo"), ("edit", None, "fixed"), ("delta", None, "!"))
    add("c", 3, ("open", "assistant", None), ("delta", None, "gone"), ("remove", None, None))
    add("c", 4, ("open", "assistant", None), ("delta", None, None), ("seen", None, "ignored"))
    add("d", 0, ("open", "assistant", None), ("remove", None, None))
    add(None, None, ("open", None, None), ("delta", None, "no id"))
    add("b", 5, ("open", "user", None), ("remove", None, None), ("open", "system", None), ("delta", None, "back"))
    return e


EXPECTED = {
    "c": [("user", "Hello"), ("assistant", "second </turn>"), ("user", "fixed!"), ("assistant", "")],
    None: [("", "no id")],
    "b": [("system", "back")],
}


def digest_of(turns, learned="assistant"):
    said = [t for r, t in turns if r == learned]
    chars = sum(len(chat.HEAD + chat.escape_role(r) + ":\n" + chat.escape(t) + chat.END) for r, t in turns)
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            sum(map(len, said)), hashlib.sha256("".join(said).encode()).hexdigest(), chars)


def read_digests(parts):
    rows = chat.digests(parts).collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def test_fold_in_any_order_of_rows(spark):
    rows = log_rows()
    for shuffled in (rows, rows[::-1]):
        parts = chat.format_chats(spark.createDataFrame(shuffled, LOG).repartition(3))
        found = {}
        for r in parts.orderBy("conv", "chunk", "part").collect():
            found.setdefault(r.conv, []).extend(chat.read_back(r.text, [s.asDict() for s in r.loss])[0])
        assert found == EXPECTED
        assert read_digests(parts) == {c: digest_of(t) for c, t in EXPECTED.items()}


def test_hot_conversation_over_many_parts_and_ranges(spark):
    turns = {"hot": [("assistant" if i % 2 else "user", f"turn {i} " + "x" * (i % 50)) for i in range(600)],
             "b": [("user", "y" * 300)], "z": [("user", ""), ("assistant", "#" * 9)]}
    rows = [(c, i, r, t) for c, ts in turns.items() for i, (r, t) in enumerate(ts)]
    table = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")                  # small ranges stay apart
    for size in (200, chat.PART_CHARS):
        parts = chat.format_chats(chat.events_of(table), part_chars=size)
        hot = parts.where("conv = 'hot'").agg(F.countDistinct("chunk"), F.count("*"), F.sum("turns")).first()
        assert hot[0] > 1 and hot[2] == 600 and (hot[1] > 100) == (size == 200)
        assert read_digests(parts) == {c: digest_of(ts) for c, ts in turns.items()}
    spark.conf.set(merge, before)


def test_parts_of_long_conversations():
    """A task's parts: first, last and long conversations are passed on, others digested."""
    turns = [("user", "hello"), ("assistant", "yes")]

    def part(conv, n):
        p = chat._Part("assistant")
        for role, text in turns:
            p.add(role, text)
        return (conv, 0, n, "".join(p.pieces), p.loss)

    rows = [part("a", 0), part("b", 0), part("b", 1), *[part("c", i) for i in range(20)], part("d", 0), part(None, 0)]
    first = list(chat._digest_inner(rows))
    kinds = [(r[0], r[3] is None) for r in first]
    assert kinds == [("a", False), ("b", True), *[("c", False)] * 20, ("d", True), (None, False)]
    done = {r[0]: r[1:] for r in chat._digest_rest(first)}
    assert done == {"a": digest_of(turns), "b": digest_of(turns * 2), "c": digest_of(turns * 20),
                    "d": digest_of(turns), None: digest_of(turns)}


def test_events_of_edge_rows(spark):
    long_text = "ab😀" * 5000
    rows = [(1, 0, "user", long_text), (1, 1, "assistant", None), (1, 1, "assistant", None), (2, None, None, "n"),
            (2, 0, "user", ""), (None, 3, "user", "q"), (3, 0, "user", "same"), (3, 0, "user", "same")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit(1))
    want = {1: [("user", long_text), ("assistant", ""), ("assistant", "")], 2: [("", "n"), ("user", "")],
            None: [("user", "q")], 3: [("user", "same"), ("user", "same")]}
    assert read_digests(chat.format_chats(chat.events_of(table))) == {c: digest_of(t) for c, t in want.items()}
    assert read_digests(chat.format_chats(chat.events_of(table.where("false")))) == {}
