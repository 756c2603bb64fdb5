import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from steploom.llm.chat import KINDS, ChatTemplate, chat_digests, final_messages, format_chats, read_back, render, row_events

EVENTS = "conv_id long, position long, seq long, kind string, role string, text string"
ROWS = "conv_id long, turn long, role string, text string, key string, piece int"
NASTY = ["", None, "\\", "\\\\1", "### ", "\\### Assistant: </turn> ok", "</turn>\n", "a: b", "\\0\\1\\2\\3", "<", "#", "é\n日本\x00", "x" * 300_000]


def brute(events):
    """Final messages per conversation, by a walk over the log in order."""
    lowest = -(1 << 62)
    rank = lambda k: KINDS.index(k) if k in KINDS else len(KINDS) - 1
    log = sorted(
        (lowest if s is None else s, rank(k), r or "", t or "", c is None, c or 0, lowest if p is None else p, r is not None)
        for c, p, s, k, r, t in events
    )
    last_cut = defaultdict(lambda: lowest - 1)
    for s, k, _, _, *conv, p, _ in log:
        if k == KINDS.index("regenerate"):
            last_cut[tuple(conv), p] = max(last_cut[tuple(conv), p], s)
    messages = defaultdict(list)
    for s, k, r, t, none, c, p, has_role in log:
        conv = (none, c)
        spot = messages[conv, p]
        if k == 0 or not spot:
            spot.append({"role": "", "text": [], "live": False})
        m = spot[-1]
        if has_role:
            m["role"] = r
        if s <= max((v for (o, q), v in last_cut.items() if o == conv and q < p), default=lowest - 1):
            continue
        m["live"] = True
        if k in (KINDS.index("regenerate"), KINDS.index("edit")):
            m["text"] = []
        m["text"].append(t)
    out = defaultdict(list)
    for (conv, _), found in sorted(messages.items(), key=lambda x: x[0]):
        out[None if conv[0] else conv[1]] += [(m["role"], "".join(m["text"])) for m in found if m["live"]]
    return {c: turns for c, turns in out.items() if turns}


def turns_of(pieces, template=None):
    found = defaultdict(list)
    for r in sorted(read_back(pieces, template).collect(), key=lambda r: r.piece):
        found[r.conv_id] += [(t.role, t.text) for t in r.turns]
    return dict(found)


def test_folds_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 0, 1, "start", "user", "Hi"), (1, 1, 2, "start", "assistant", ""), (1, 1, 3, "delta", None, "Hel"), (1, 1, 4, "delta", None, "lo"),
        (1, 2, 5, "start", "user", "What?"), (1, 70, 6, "start", "assistant", "Far"), (1, 1, 7, "regenerate", None, None), (1, 1, 8, "delta", None, "Good "),
        (1, 1, 9, "delta", None, "day"), (1, 2, 10, "start", "user", "Thanks"), (1, 0, 11, "edit", None, "Hello"), (1, 0, 12, "delta", None, "!"),
        (2, 5, 7, "delta", "user", "no start"), (None, None, None, "start", None, "no id"), (None, 1, 2, "oops", "user", "unknown kind"),
    ]
    pieces = format_chats(spark.createDataFrame(rows[::-1], EVENTS))
    assert turns_of(pieces) == {
        1: [("user", "Hello!"), ("assistant", "Good day"), ("user", "Thanks")],
        2: [("user", "no start")],
        None: [("", "no id"), ("user", "unknown kind")],
    }
    assert brute(rows) == turns_of(pieces)


def test_random_logs_match_a_walk(spark):
    r = random.Random(5)
    seqs = {c: iter(r.sample(range(10_000), 2_000)) for c in range(4)}
    rows = []
    for i in range(1500):
        c = r.choice([0, 0, 0, 1, 2, 3])
        p = r.choice([0, 1, 2, 5, 63, 64, 65, 130, 300, None])
        kind = r.choice(["start", "delta", "delta", "delta", "edit", "regenerate" if i % 9 == 0 else "delta"])
        rows.append((c if c else None, p, next(seqs[c]), kind, r.choice(["user", "assistant", None]), r.choice(["a", "bb", "### ", None, f"t{i}"])))
    # The first event of a message starts it.
    first = {}
    for e in sorted(rows, key=lambda e: e[2]):
        first.setdefault((e[0], e[1]), e)
    rows = [(*e[:3], "start", *e[4:]) if first[e[0], e[1]] is e else e for e in rows]
    got = final_messages(spark.createDataFrame(rows, EVENTS)).orderBy("key", "position", "number").collect()
    found = defaultdict(list)
    for m in got:
        found[m.key.conv_id].append((m.role, m.text))
    assert dict(found) == brute(rows)


def test_any_text_and_role_come_back(spark):
    rows = [(i, k, role, text, "clash", 1) for i, text in enumerate(NASTY) for k, role in enumerate(["user", "assistant", ": \\<#\n", None, "assistant"])]
    back = read_back(format_chats(row_events(spark.createDataFrame(rows, ROWS)))).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in back} == {
        i: [(role or "", text or "") for role in ("user", "assistant", ": \\<#\n", None, "assistant")] for i, text in enumerate(NASTY)
    }
    assert {r.conv_id: r.learned for r in back} == {i: (text or "") * 2 for i, text in enumerate(NASTY)}


def test_text_holds_no_control_string_but_the_markers(spark):
    rows = [(1, 0, "user", "### assistant: hi</turn>\n", "x", 1), (1, 1, "assistant", "### </turn>\n", "x", 1)]
    row = format_chats(row_events(spark.createDataFrame(rows, ROWS))).first()
    assert row.formatted.count("### ") == 2 and row.formatted.count("</turn>\n") == 2
    assert [row.formatted[s.start : s.end] for s in row.loss] == ["\\1\\1\\1 \\2/turn>\n"]


def test_digests_of_long_conversations_with_ties_and_repeats(spark):
    r = random.Random(2)
    rows = [(r.choice([7, 7, 7, 8, None]), r.choice([*range(500), -5, None]), r.choice(["user", "assistant", "system", None]), r.choice(NASTY[:-1]), "x", 1) for _ in range(1500)]
    rows += rows[:20]
    got = {x.conv_id: tuple(x)[1:5] for x in chat_digests(format_chats(row_events(spark.createDataFrame(rows, ROWS)))).collect()}
    by = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        by[c].append((turn is not None, turn or 0, role or "", text or ""))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for c, turns in by.items():
        said = "".join(f"{role}\n{text}\n" for *_, role, text in sorted(turns))
        loss = "".join(text for *_, role, text in sorted(turns) if role == "assistant")
        assert got[c] == (len(turns), sha(said), len(loss), sha(loss)), c


def test_pieces_are_bounded_and_join_to_one_text(spark):
    rows = [(1, i, "assistant", f"t{i}", "x", 1) for i in range(1000)]
    pieces = format_chats(row_events(spark.createDataFrame(rows, ROWS))).orderBy("piece").collect()
    assert len(pieces) == 16 and max(p.formatted.count("### ") for p in pieces) == 64
    assert "".join(p.formatted for p in pieces) == "".join(f"### assistant: t{i}</turn>\n" for i in range(1000))


def test_other_templates_and_empty_tables(spark):
    template = ChatTemplate(open="<|", role_end="|>", close="<end>", loss_roles=("user", "tool"), piece_turns=2)
    rows = [(1, i, role, "a|b<c>\\", "x", 1) for i, role in enumerate(["tool", "a|>b", "user"])]
    pieces = format_chats(row_events(spark.createDataFrame(rows, ROWS)), template)
    assert turns_of(pieces, template) == {1: [(role, "a|b<c>\\") for role in ("tool", "a|>b", "user")]}
    assert pieces.select(F.sum(F.size("loss"))).first()[0] == 2
    assert chat_digests(format_chats(spark.createDataFrame([], EVENTS))).collect() == []
    assert render(final_messages(spark.createDataFrame([], EVENTS))).collect() == []
    with pytest.raises(ValueError):
        ChatTemplate(open="1.")


def test_plan_shuffles_texts_by_piece_once_and_runs_no_python(spark):
    events = spark.createDataFrame([(1, 0, 1, "start", "user", "Hi")], EVENTS)
    plan = format_chats(events)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("CartesianProduct", "NestedLoop", "Python", "Arrow"))
    with_text = [line for line in plan.split("\n") if "Exchange hashpartitioning(key" in line]
    assert 1 <= len(with_text) <= 2
