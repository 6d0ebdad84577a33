"""Conversation repair against a plain search over all edits, and on odd, long and empty tables."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from millrace.llm import conversations
from millrace.llm.queries import QUERIES
from millrace.llm.turn_grammar import Grammar, Rope, count_digrams

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def damage(conv_id, turn, role, text):
    key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
    kind = zlib.crc32(key.encode()) % 20
    role, text = " " if role is None else role, " " if text is None else text
    if kind == 0:
        return []
    if kind == 1:
        text = ""
    if kind == 2:
        text = re.sub("[.!?]", "", text)
    if kind == 4:
        role = "user"
    return [(turn, role, text)] * (2 if kind == 3 else 1)


def faults_of(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        solid = text.strip(BLANKS)
        if not solid:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif solid[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append(None)
        seen.add((role, text))
    return faults


STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows, faults):
    """Least (cost, audit, repaired) by dynamic programming over whole strings, two inserts at most between rows."""
    best = {"": (0, "", ())}

    def put_in(states):
        for _ in range(2):
            for state, (cost, audit, out) in list(states.items()):
                role = "assistant" if state == "u" else "user"
                new = (cost + 3, audit + "I", (*out, f"{role}:"))
                if role[0] not in states or new[:2] < states[role[0]][:2]:
                    states[role[0]] = new
        return states

    best = put_in(best)
    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}

        def offer(state, cost, audit, out, after=after):
            if state not in after or (cost, audit) < after[state][:2]:
                after[state] = (cost, audit, out)

        for state, (cost, audit, out) in best.items():
            offer(state, cost + 4, audit + "D", out)
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault == "truncated" else 0
            if (state, role[:1]) in STEP:
                offer(STEP[state, role[:1]], cost + extra, audit + "K", (*out, f"{role}:{text}"))
            for new in ("user", "assistant"):
                if (state, new[0]) in STEP:
                    offer(STEP[state, new[0]], cost + extra + 3, audit + "R", (*out, f"{new}:{text}"))
        best = put_in(after)
    return min(best[s] for s in ("", "a") if s in best)


def expected(rows):
    by_conv = {}
    for conv_id, turn, role, text in rows:
        by_conv.setdefault(conv_id, []).extend(damage(conv_id, turn, role, text))
    out = {}
    for conv_id, turns in by_conv.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        faults = faults_of(turns)
        cost, audit, repaired = cheapest(turns, faults)
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv_id] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def got(table):
    rows = conversations.repair_conversations(conversations.damaged(table)).collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


def random_rows(seed, conversations_, most):
    rng = random.Random(seed)
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "Übung", "superuser"]
    texts = ["yes.", "no!", "why?", "cut off", " \t", "", None, "a. ", "b.\n", "long " * 30 + "."] + [f"text {i}." for i in range(30)]
    rows = []
    for conv in [None, *range(conversations_)]:
        for i in range(rng.randrange(1, most)):
            turn = None if rng.random() < 0.1 else i + rng.choice([0, 0, 0, 0, 3])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    rows += rows[5:9]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk", [3, conversations.CHUNK])
def test_repairs_match_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversations, "CHUNK", chunk)
    rows = random_rows(7, 120, 25)
    assert got(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(3)
    rows = [(1, i // 2, rng.choice(["user", "assistant", "tool"]), rng.choice(["same.", f"t{i}.", f"t{i}", ""])) for i in range(12_000)]
    rows += [(i, 0, "user", "one.") for i in range(2, 40)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_query_matches_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    want = expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    result = QUERIES["op11_conversation_repair"](spark, sf_dir)
    assert {r["conv_id"]: tuple(r)[1:] for r in result.collect()} == want
    assert {r["conv_id"] for r in table.collect()} == set(want)


def test_odd_tables(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == {}
    clash = spark.createDataFrame(
        [(1, 1, "user", "a.", 9, "x", "y"), (1, 2, "user", "b.", 9, "x", "y")],
        "conv_id long, turn long, role string, text string, copy int, kind string, audit string",
    )
    assert got(clash) == expected([(1, 1, "user", "a."), (1, 2, "user", "b.")])
    dropped = next(i for i in range(1000) if not damage(i, 1, "user", "x."))
    empty = hashlib.sha256(b"").hexdigest()
    assert got(spark.createDataFrame([(dropped, 1, "user", "x.")], SCHEMA)) == {dropped: (0, 0, 0, 0, 0, 0, "", empty)}


def test_repaired_rows_alternate(spark):
    rows = spark.createDataFrame([(i, t, r, x) for i, t, r, x in random_rows(11, 40, 12) if r], SCHEMA)
    turns = conversations.damaged(rows)
    plans = conversations.repair_plans(turns)
    by_conv = {}
    for r in conversations.repaired_rows(turns, plans).collect():
        by_conv.setdefault(r["conv_id"], []).append((r["position"], r["role"][:1], r["edit"]))
    audits = {r["conv_id"]: r["audit"] for r in plans.collect()}
    for conv, found in by_conv.items():
        found.sort()
        assert [p for p, _, _ in found] == list(range(len(found)))
        assert re.fullmatch("(s?(ua)+)?", "".join(role for _, role, _ in found))
        assert "".join(e for _, _, e in found) == audits[conv].replace("D", "")


def test_rules_change_no_result():
    rng = random.Random(5)
    plain, rules = Grammar(()), []
    sequences = ["".join(rng.choices("DsuaoSUAO", [2, 1, 6, 6, 1, 1, 2, 2, 1], k=rng.randrange(60))) for _ in range(300)]
    for _ in range(4):
        packed = [(Grammar(rules).compressed(s), 1) for s in sequences]
        rules += [p for p, n in count_digrams(packed).most_common(12) if n > 1]
    shared = Grammar(rules)
    assert any(len(shared.compressed(s)) < len(s) / 2 for s in sequences if s)
    for s in sequences:
        a, b = plain.repair([s]), shared.repair([s[i : i + 17] for i in range(0, max(len(s), 1), 17)])
        assert (a[0], str(a[1])) == (b[0], str(b[1]))


def test_ropes_compare_like_texts():
    rng = random.Random(2)
    made = [("", Rope())] + [(c, Rope(c)) for c in "DIKR"]
    for _ in range(400):
        (a, x), (b, y) = rng.choice(made), rng.choice(made)
        if len(a) + len(b) < 300:
            made.append((a + b, x + y))
    for _ in range(3000):
        (a, x), (b, y) = rng.choice(made), rng.choice(made)
        assert (x < y) == (a < b) and str(x) == a
