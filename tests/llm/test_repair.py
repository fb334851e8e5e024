import hashlib
import itertools
import random
import re
import zlib

import pytest

from ladle.llm import repair

LEGAL = re.compile("(s?(ua)+)?").fullmatch


def brute(rows):
    """Counts, cost, edits and repaired turns of sorted rows (turn, role, text), by trying all edits of least cost."""
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    best = None

    def go(i, cost, audit, out):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows):
            for more in ([], ["user"], ["assistant"], ["user", "assistant"]):
                kept = out + [(r, "") for r in more]
                if LEGAL("".join(r[:1] or "?" for r, _ in kept)):
                    found = (cost + 3 * len(more), audit + "I" * len(more), kept)
                    best = found if best is None or found[:2] < best[:2] else best
            return
        _, role, text = rows[i]
        for more in ([], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]):
            head, price, letters = out + [(r, "") for r in more], cost + 3 * len(more), audit + "I" * len(more)
            go(i + 1, price + 4, letters + "D", head)
            if faults[i] not in ("blank", "duplicate"):
                more_cost = 3 if faults[i] == "truncated" else 0
                go(i + 1, price + more_cost, letters + "K", head + [(role, text)])
                for other in ("user", "assistant"):
                    go(i + 1, price + 3 + more_cost, letters + "R", head + [(other, text)])

    go(0, 0, "", [])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, kept = best
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest


def conversations():
    rng = random.Random(4)
    texts = ["Yes.", "No!", "cut off", "", "  ", "Why?\n", "é 東京。", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    out = []
    for conv in range(60):
        for turn in range(rng.randint(0, 5)):
            out.append((conv, rng.choice([turn, turn, turn * 2, None]), rng.choice(roles), rng.choice(texts)))
    return out + [(None, 3, "user", "A row without a conversation."), (None, 1, "system", "Rules.")]


def by_conversation(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, x in groups.items()}


@pytest.mark.parametrize("chunk", [200_000, 2, 1])
def test_audit_is_the_cheapest(spark, work, chunk):
    rows = conversations()
    turns = spark.createDataFrame([(*r, "x", True) for r in rows], "conv_id long, turn long, role string, text string, conv string, repeated boolean").repartition(3)
    found = {r.conv_id: tuple(r)[1:] for r in repair.audit(turns, work(), chunk_rows=chunk).collect()}
    assert found == {c: brute(x) for c, x in by_conversation(rows).items()}


@pytest.mark.parametrize("chunk", [200_000, 2])
def test_edits(spark, work, chunk):
    """The edits make legal turns, hold every row once in order, and give back the audit."""
    rows = conversations()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    audits = {r.conv_id: r.audit for r in repair.audit(turns, work()).collect()}
    edits = {}
    for r in repair.repair(turns, work(), chunk_rows=chunk).orderBy("conv_id", "step").collect():
        edits.setdefault(r.conv_id, []).append(r)
    for conv, own in by_conversation(rows).items():
        assert "".join(r.edit for r in edits[conv]) == audits[conv] and [r.step for r in edits[conv]] == list(range(len(edits[conv])))
        assert LEGAL("".join(r.role[:1] or "?" for r in edits[conv] if r.edit != "D"))
        left = [(r.turn, r.text) for r in edits[conv] if r.edit != "I"]
        assert left == [(t, x) for t, _, x in own]


def test_a_giant_conversation(spark, work):
    """One conversation far beyond a chunk, beside small ones; chunks don't change what is found."""
    turns = spark.range(60_000).selectExpr("if(id < 59000, 1, id) conv_id", "id turn", "if(id % 7 < 3, 'user', 'assistant') role", "concat('word ', id % 5000, if(id % 11 = 0, '', '.')) text")
    whole = sorted(map(tuple, repair.audit(turns, work()).collect()))
    assert whole == sorted(map(tuple, repair.audit(turns, work(), chunk_rows=700, chunk_chars=9000).collect()))
    assert len(whole) == 1001 and len(whole[0][7]) >= 59_000


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    found = {}
    for r in repair.damaged(spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, fault int")).collect():
        found.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = (role or " ", text or " ")
        want = {0: [], 1: [(own[0], "")], 2: [(own[0], own[1].translate(str.maketrans("", "", ".!?")))], 3: [own, own], 4: [("user", own[1])]}.get(fault, [own])
        assert found.get((conv, turn), []) == want


def test_empty(spark, work):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.audit(none, work()).collect() == [] and repair.repair(none, work()).collect() == [] and repair.damaged(none).collect() == []
