"""Repair of conversations against a plain search over strings, with edge cases."""

import binascii
import hashlib
import random
import re

import pytest
from conftest import SMALL

from tablemill.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, conv string, cost string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        role, text = show(role), show(text)
        deal = binascii.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if deal == 0:
            continue
        text = "" if deal == 1 else re.sub(r"[.!?]", "", text) if deal == 2 else text
        out += [(conv, turn, "user" if deal == 4 else role, text)] * (2 if deal == 3 else 1)
    return out


def plain(turns):
    """Counts, cost, audit and repaired lines of one conversation, with whole strings."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
    seen, faults = set(), []
    for _, role, text in turns:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    # State: the last role given, "" at first.
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def insertions(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for t in "ua":
                    to = after.get((state, t))
                    if to:
                        offer = (cost + 5, audit + "I", [*lines, names[t] + ":"])
                        best[to] = min(best.get(to, offer), offer)
        return best

    best = {"": (0, "", [])}
    for (_, role, text), fault in zip(turns, faults):
        found = {}

        def offer(to, cost, audit, lines):
            if to is not None:
                found[to] = min(found.get(to, (cost, audit, lines)), (cost, audit, lines))

        for state, (cost, audit, lines) in insertions(best).items():
            offer(state, cost + 2, audit + "D", lines)
            if fault not in ("blank", "duplicate"):
                cost += 5 * (fault == "truncated")
                offer(after.get((state, role[:1])), cost, audit + "K", [*lines, f"{role}:{text}"])
                for t in "ua":
                    offer(after.get((state, t)), cost + 1, audit + "R", [*lines, f"{names[t]}:{text}"])
        best = found
    cost, audit, lines = min(v for s, v in insertions(best).items() if s in ("", "a"))
    numbers = {t[0] for t in turns if t[0] is not None}
    pairs = [a[1][:1] + b[1][:1] if a[1] and b[1] else "" for a, b in zip(turns, turns[1:])]
    return (
        max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def expected(rows, ids):
    return {c: plain([r[1:] for r in rows if r[0] == c]) for c in ids}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def digests(spark, rows, partitions=4):
    found = repair.repair_conversations(frame(spark, rows).repartition(partitions))
    return {r[0]: tuple(r)[1:] for r in repair.conversation_digests(found).collect()}


def some_rows(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        n = rng.randint(0, longest)
        for i in range(n):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            if rng.random() < 0.7:
                role = ("user", "assistant")[i % 2]
            text = rng.choice(["Yes.", "No!", "cut", "", " \t", None, f"Text {c} {i}.", f"Text {c} {i}?  \n", "é\x00."])
            rows.append((c, rng.choice([i, i, i, i // 2, None, i + 3]), role, text))
    return rows


@pytest.mark.parametrize("turns, characters", [(2_000, 4_000_000), (3, 4_000_000), (1, 4_000_000), (50, 10)])
def test_against_plain(spark, monkeypatch, turns, characters):
    """Whole conversations and divided ones give the same."""
    monkeypatch.setattr(repair, "PIECE_TURNS", turns)
    monkeypatch.setattr(repair, "PIECE_CHARACTERS", characters)
    rows = some_rows(turns, 60, 12)
    rows += [(None, 1, "user", "A."), (None, 2, "assistant", "B."), (None, None, "system", "S.")]
    rows += [rows[0]] * 3
    assert digests(spark, rows) == expected([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows], {r[0] for r in rows})


def test_hot_conversation(spark, monkeypatch):
    """One conversation over many ranges and pieces."""
    monkeypatch.setattr(repair, "PIECE_TURNS", 40)
    rng = random.Random(8)
    rows = [(7, i, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Same.", f"T{i}.", f"cut{i}"])) for i in range(900)]
    rows += [(8, 1, "user", "Same.")] * 500 + [(9, 0, "user", "A."), (9, 1, "assistant", "B.")]
    found = repair.repair_conversations(frame(spark, rows).repartition(6)).where("conv_id = 7")
    assert found.count() > 10
    assert digests(spark, rows) == expected(rows, {7, 8, 9})


def test_damage(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(None, None, None, None), (None, 3, "user", None), (400, None, None, "x.?! y")] + [(c, t, "user", "Hm.") for c in range(500, 520) for t in (0, None)]
    rows += [(c, 0, "user", "Alone.") for c in range(600, 900)]
    found = repair.repair_conversations(repair.damage(frame(spark, rows)), copies_column="copies")
    got = {r[0]: tuple(r)[1:] for r in repair.conversation_digests(found).collect()}
    assert got == expected(damaged(rows), {r[0] for r in rows})
    # Some conversations lose all their rows.
    assert any(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for v in got.values())


def test_repaired_turns(spark):
    rows = [(1, 1, "user", "A."), (1, 2, "user", "A."), (1, 3, "tool", "C."), (1, 4, "user", "D.")]
    found = repair.repair_conversations(frame(spark, rows)).first()
    assert found.audit == "KDDR" and [tuple(t) for t in found.turns] == [("user", "A."), ("assistant", "D.")]


def test_empty_table(spark):
    found = repair.repair_conversations(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0 and repair.conversation_digests(found).count() == 0


def test_very_long_text(spark):
    text = "word " * 200_000 + "." + " " * 100_000
    rows = [(1, 0, "user", text), (1, 1, "assistant", "ok"), (1, 2, "assistant", text)]
    assert digests(spark, rows) == expected(rows, {1})


def test_grammars():
    with pytest.raises(ValueError, match="finitely"):
        repair.Automaton((("S", ("u", "S", "a")), ("S", ("u", "a"))))
    machine = repair.Automaton(repair.RULES)
    assert machine.terminals == {"s", "u", "a"} and len(machine.stacks) == 8
