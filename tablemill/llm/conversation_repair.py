r"""Repair of the structure of conversations by a generalised LR parser over role initials.

The grammar of a conversation is in ``RULES``: nothing, or turns of user and assistant in pairs, with
or without one of the system before them. An SLR automaton is built from it. The parser reads the
turns and keeps a graph-structured stack: stacks share what lies below, and those with equal
tops merge into the one of minimum (cost, audit). For each turn it may keep (K), rerole to
user or assistant (R) or delete (D), and insert turns (I) before it and at the end. The audit is
the string of these letters, so of repairs of equal cost the one whose letters are least in
ASCII order wins.

Audits are never compared letter by letter: after a turn all audits end in the letter of that turn,
none begins another, so the order of two of them stays what it was when they parted. Each stack
carries the rank of its audit, and letters are only kept as one step per turn.

That makes long conversations divisible. Turns are sorted by ranges over the whole cluster, and each
task cuts its rows into pieces. A piece that holds its whole conversation is repaired at once. Of the
others, each gives a small table: for every stack it may begin with, the cost and rank of every stack
it may end with. These tables are folded per conversation, which fixes the stacks at the ends of every
piece, and then all pieces are repaired side by side.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tablemill.session import staged
from tablemill.spec import col

RULES = (("Conversation", ()), ("Conversation", ("Pairs",)), ("Conversation", ("s", "Pairs")),
         ("Pairs", ("u", "a")), ("Pairs", ("Pairs", "u", "a")))
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
# A piece ends after so many different turns, or so many characters of text.
PIECE_TURNS, PIECE_CHARACTERS = 2_000, 4_000_000
# Ranges of turns are told apart by so many leading characters, where all else is equal.
LEAD = 64
FINE, CUT, FORCED = 0, 1, 2


class Automaton:
    """SLR automaton of ``RULES``; a stack is a tuple of state numbers."""

    def __init__(self, rules):
        self.rules = (("Start", (rules[0][0],)), *rules)
        self.nonterminals = {left for left, _ in self.rules}
        self.terminals = {x for _, right in self.rules for x in right} - self.nonterminals
        states = [self.closure({(0, 0)})]
        self.goto: dict[tuple[int, str], int] = {}
        for state in states:
            for symbol in sorted(self.terminals | self.nonterminals):
                moved = {(r, dot + 1) for r, dot in state if self.after(r, dot) == symbol}
                if moved:
                    to = self.closure(moved)
                    if to not in states:
                        states.append(to)
                    self.goto[states.index(state), symbol] = states.index(to)
        # States without a choice reduce at once, others only at the end (the one lookahead
        # that tells them apart here).
        self.ready = [[r for r, dot in sorted(s) if dot == len(self.rules[r][1])] for s in states]
        self.only = [len(ready) == 1 == len(state) for ready, state in zip(self.ready, states)]
        self.stacks = [(0,)]
        for stack in self.stacks:
            for to in filter(None, (self.shift(stack, t) for t in sorted(self.terminals))):
                if to not in self.stacks:
                    self.stacks.append(to)
            if len(self.stacks) > 100:
                raise ValueError("the stacks of this grammar are not finitely many")
        self.number = {stack: i for i, stack in enumerate(self.stacks)}
        self.check_tops()

    def after(self, rule: int, dot: int) -> str | None:
        right = self.rules[rule][1]
        return right[dot] if dot < len(right) else None

    def closure(self, items: set) -> frozenset:
        todo, done = list(items), set(items)
        while todo:
            symbol = self.after(*todo.pop())
            for i, (left, _) in enumerate(self.rules):
                if left == symbol and (i, 0) not in done:
                    done.add((i, 0))
                    todo.append((i, 0))
        return frozenset(done)

    def reduce(self, stack: tuple, rule: int) -> tuple:
        left, right = self.rules[rule]
        below = stack[: len(stack) - len(right)]
        return (*below, self.goto[below[-1], left])

    def shift(self, stack: tuple, terminal: str) -> tuple | None:
        to = self.goto.get((stack[-1], terminal)) if terminal in self.terminals else None
        if to is None:
            return None
        stack = (*stack, to)
        while self.only[stack[-1]] and self.ready[stack[-1]][0]:
            stack = self.reduce(stack, self.ready[stack[-1]][0])
        return stack

    def accepts(self, stack: tuple) -> bool:
        while self.ready[stack[-1]]:
            rule = self.ready[stack[-1]][0]
            if rule == 0:
                return True
            stack = self.reduce(stack, rule)
        return False

    def check_tops(self) -> None:
        """Stacks with equal tops must go on alike, or merging them would lose repairs."""
        kind = {s: int(self.accepts(s)) for s in self.stacks}
        while True:
            seen: dict = {}
            finer = {}
            for s in self.stacks:
                to = [self.shift(s, t) for t in sorted(self.terminals)]
                sign = (kind[s], *[kind.get(x, -1) if x else -1 for x in to])
                finer[s] = seen.setdefault(sign, len(seen))
            if len(set(finer.values())) == len(set(kind.values())):
                break
            kind = finer
        tops: dict[int, int] = {}
        for s in self.stacks:
            if tops.setdefault(s[-1], kind[s]) != kind[s]:
                raise ValueError("stacks with equal tops differ in what may follow")

    @lru_cache(maxsize=None)
    def inserted(self, stack: tuple) -> tuple:
        """Stacks reached by insertions alone, with the number of these; each top once."""
        out, tops = [(stack, 0)], {stack[-1]}
        for now, n in out:
            for t in ROLES:
                to = self.shift(now, t)
                if to and to[-1] not in tops:
                    tops.add(to[-1])
                    out.append((to, n + 1))
        return tuple(out)

    @lru_cache(maxsize=None)
    def moves(self, stack: tuple, initial: str, fault: int) -> tuple:
        """``(stack, cost, letters)`` after one turn, the best for each top."""
        best: dict[int, tuple] = {}

        def offer(to, cost, letters):
            if to and (to[-1] not in best or (cost, letters) < best[to[-1]][1:]):
                best[to[-1]] = (to, cost, letters)

        for now, n in self.inserted(stack):
            cost, letters = INSERT * n, "I" * n
            offer(now, cost + DELETE, letters + "D")
            if fault != FORCED:
                cost += TRUNCATED * (fault == CUT)
                offer(self.shift(now, initial), cost, letters + "K")
                for t in ROLES:
                    offer(self.shift(now, t), cost + REROLE, letters + "R")
        return tuple(best.values())

    @lru_cache(maxsize=None)
    def endings(self, stack: tuple) -> tuple:
        """``(cost, letters)`` of insertions to an accepted stack."""
        return tuple((INSERT * n, "I" * n) for to, n in self.inserted(stack) if self.accepts(to))


@lru_cache(maxsize=1)
def automaton() -> Automaton:
    return Automaton(RULES)


def search(turns: list[tuple[str, int, int]], stack: tuple) -> tuple[dict, list[dict]]:
    """The graph-structured stack over ``turns`` (initial, fault, further copies).

    Returns the last tops as ``top -> (cost, rank, stack)`` and for each turn its links
    ``top -> (top before, letters)``.
    """
    moves = automaton().moves
    tops = {stack[-1]: (0, 0, stack)}
    links = []
    for initial, fault, copies in turns:
        found: dict[int, tuple] = {}
        for top, (cost, rank, now) in tops.items():
            for to, more, letters in moves(now, initial, fault):
                offer = (cost + more, rank, letters, top, to)
                if to[-1] not in found or offer < found[to[-1]]:
                    found[to[-1]] = offer
        order = sorted(found, key=lambda t: found[t][1:3])
        tops = {t: (found[t][0] + DELETE * copies, i, found[t][4]) for i, t in enumerate(order)}
        links.append({t: (found[t][3], found[t][2] + "D" * copies) for t in order})
    return tops, links


def ending(tops: dict) -> tuple[int, int, str]:
    """``(cost, top, letters)`` of the best end."""
    ends = [
        (cost + more, rank, letters, top)
        for top, (cost, rank, now) in tops.items()
        for more, letters in automaton().endings(now)
    ]
    cost, _, letters, top = min(ends)
    return cost, top, letters


def letters_to(links: list[dict], top: int) -> list[str]:
    """Letters of each turn on the way to a last top."""
    out = []
    for step in reversed(links):
        top, letters = step[top]
        out.append(letters)
    return out[::-1]


def apply_letters(turns: list[tuple[str, str]], letters: list[str], tail: str, stack: tuple) -> list[dict]:
    """Repaired turns of ``turns`` (role, text) from a stack on; inserted ones are empty."""
    machine, out = automaton(), []

    def put(role, text):
        nonlocal stack
        if role is None:
            role = next(ROLES[t] for t in ROLES if machine.shift(stack, t))
        stack = machine.shift(stack, role[:1])
        out.append({"role": role, "text": text})

    for (role, text), word in zip([*turns, (None, "")], [*letters, tail]):
        for letter in word:
            if letter == "I":
                put(None, "")
            elif letter == "K":
                put(role, text)
            elif letter == "R":
                put(None, text)
    return out


# Rows and pieces


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with the faults that the checksum of ``conv:turn`` deals, and ``copies``: 0 for
    a dropped row, 2 for a repeated one. Null roles and texts become one blank."""
    blank = lambda c: F.coalesce(col(c).cast("string"), F.lit(" "))
    deal = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn)).cast("binary")) % 20
    rows = df.select(col(conv).alias(conv), col(turn).alias(turn), blank(role).alias(role), blank(text).alias(text), deal.alias("deal"))
    return rows.select(
        col(conv), col(turn),
        F.when(F.col("deal") == 4, "user").otherwise(col(role)).alias(role),
        F.when(F.col("deal") == 1, "").when(F.col("deal") == 2, F.translate(col(text), "".join(ENDS), "")).otherwise(col(text)).alias(text),
        F.when(F.col("deal") == 0, 0).when(F.col("deal") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def sorted_turns(df: DataFrame, conv: str, turn: str, role: str, text: str, copies: Column) -> DataFrame:
    """Different turns in order, by ranges: ``conv``, ``turn``, ``role``, ``text``,
    ``copies``, ``blank``, ``cut``, ``again``. Equal rows are one with its copies; a
    conversation without rows has one with none."""
    there = copies > 0
    blank = lambda c: F.coalesce(col(c).cast("string"), F.lit(" "))
    rows = (
        df.select(
            col(conv).alias("conv"),
            F.when(there, col(turn)).cast("long").alias("turn"),
            F.when(there, blank(role)).otherwise("").alias("role"),
            F.when(there, blank(text)).otherwise("").alias("text"),
            F.when(there, copies).otherwise(0).cast("long").alias("copies"),
        )
    )
    # Where role and text return in another turn, the first turn they have. Null turns come
    # first. Written before the join, so that its size is known and the texts need not move for it.
    turn_of = F.struct(F.col("turn").isNotNull(), "turn")
    first = staged(
        rows.where("copies > 0").groupBy("conv", "role", F.sha2("text", 256).alias("said"))
        .agg(F.min(turn_of).alias("first"), F.max(turn_of).alias("final")).where("first != final")
        .select(F.col("conv").alias("c"), F.col("role").alias("r"), "said", F.col("first.turn").alias("first")),
        "returns",
    )
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    same = [F.col("conv").eqNullSafe(F.col("c")), F.col("role") == F.col("r"), F.sha2("text", 256) == F.col("said")]
    joined = rows.join(first, same, "left")
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    told = joined.select(
        "conv", "turn", "role", "text", "copies",
        (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(*ENDS)).alias("cut"),
        (F.col("said").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))).alias("again"),
    )
    return told.repartitionByRange("conv", "turn", "role", F.left("text", F.lit(LEAD))).sortWithinPartitions("conv", "turn", "role", "text")


def faults(rows: list[dict]) -> dict:
    """What a piece tells of its turns as they are: counts, ends and turn numbers."""
    blank = again = cut = illegal = 0
    before = None
    numbers = []
    for r in rows:
        n, initial = r["copies"], r["role"][:1]
        blank += n * r["blank"]
        if not r["blank"]:
            again += n - 1 + r["again"]
            cut += r["cut"] and not r["again"]
        illegal += n - 1 + (before is not None and not pair_legal(before, initial))
        before = initial
        if r["turn"] is not None and (not numbers or numbers[-1] != r["turn"]):
            numbers.append(r["turn"])
    return {
        "blank": blank, "duplicate": again, "truncated": int(cut), "illegal": illegal,
        "first": rows[0]["role"][:1] if rows else None, "last": before,
        "low": numbers[0] if numbers else None, "high": numbers[-1] if numbers else None, "numbers": len(numbers),
    }


def pair_legal(a: str, b: str) -> bool:
    return a + b in LEGAL if a and b else False


def coded(rows: list[dict]) -> list[tuple[str, int, int]]:
    fault = lambda r: FORCED if r["blank"] or r["again"] else CUT if r["cut"] else FINE
    return [(r["role"][:1], fault(r), r["copies"] - 1) for r in rows]


def mend(rows: list[dict], start: tuple, top: int | None = None, tail: str = "") -> dict:
    """Audit and repaired turns of a piece; without a given end, the best one."""
    tops, links = search(coded(rows), start)
    cost = None
    if top is None:
        cost, top, tail = ending(tops)
    letters = letters_to(links, top)
    turns = apply_letters([(r["role"], r["text"]) for r in rows], letters, tail, start)
    return {"cost": cost, "audit": "".join(letters) + tail, "turns": turns}


FAULTS = "blank long, duplicate long, truncated long, illegal long"
TURNS = "turns array<struct<role:string,text:string>>"
PIECE = (
    f"task long, number long, whole boolean, {FAULTS}, first string, last string, low long, high long, numbers long, "
    f"cost long, audit string, {TURNS}, "
    "rows array<struct<turn:long,role:string,text:string,copies:long,blank:boolean,cut:boolean,again:boolean>>, "
    "ways array<struct<start:int,end:int,cost:long,rank:int>>"
)
FACTS = ("blank", "duplicate", "truncated", "illegal")


def with_key(key: StructType, rest: str) -> StructType:
    return StructType([*key.fields, *StructType.fromDDL(rest).fields])


def cut_pieces(told: DataFrame) -> DataFrame:
    """Pieces of conversations, of bounded size; those that hold a whole one are repaired."""
    schema = with_key(told.select("conv").schema, PIECE)
    arrow = to_arrow_schema(schema)
    empty = {"cost": None, "audit": None, "turns": None, "rows": None, "ways": None}

    def piece(conv, rows, task, number, whole):
        out = {**empty, **faults(rows), "conv": conv, "task": task, "number": number, "whole": whole}
        if whole:
            return {**out, **mend(rows, automaton().stacks[0])}
        ways = []
        for i, stack in enumerate(automaton().stacks):
            tops, _ = search(coded(rows), stack)
            ways += [{"start": i, "end": automaton().number[s], "cost": c, "rank": k} for c, k, s in tops.values()]
        return {**out, "rows": rows, "ways": ways}

    def run(batches):
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        conv, rows, size = None, [], 0
        started = inner = False
        first = 0
        ready: list[dict] = []
        held = 0

        def close(whole):
            nonlocal rows, size, number, held
            ready.append(piece(conv, rows, task, number, whole))
            held += size + 200 * len(rows)
            number, rows, size = number + 1, [], 0

        def flush():
            nonlocal ready, held
            batch = pa.RecordBatch.from_pylist(ready, schema=arrow)
            ready, held = [], 0
            return batch

        for batch in batches:
            for r in batch.to_pylist():
                c = r.pop("conv")
                if not started or c != conv:
                    if started:
                        # Whole between two others; the first and last of a task may go on elsewhere.
                        close(whole=inner and first == number)
                        inner = True
                    conv, started, first = c, True, number
                elif len(rows) >= PIECE_TURNS or size >= PIECE_CHARACTERS:
                    close(whole=False)
                if r["copies"]:
                    rows.append(r)
                    size += len(r["text"])
                if held > PIECE_CHARACTERS:
                    yield flush()
        if started:
            close(whole=False)
        if ready:
            yield flush()

    return told.mapInArrow(run, schema)


def fold(parts: DataFrame) -> DataFrame:
    """The stacks at both ends of every piece of a divided conversation, and what holds for
    all of it. A task reads the small tables of a conversation in order, a few numbers for
    thousands of turns."""
    schema = with_key(
        parts.select("conv").schema,
        f"task long, number long, piece long, pieces long, start int, finish int, tail string, gaps long, {FAULTS}, cost long",
    )
    arrow = to_arrow_schema(schema)

    def settle(conv, at, facts, steps, tops):
        cost, top, tail = ending(tops)
        chosen = []
        for step in reversed(steps):
            start, finish, before = step[top]
            chosen.append((start, finish))
            top = before
        chosen.reverse()
        gaps = facts["high"] - facts["low"] + 1 - facts["numbers"] if facts["numbers"] else 0
        for i, ((task, number), (start, finish)) in enumerate(zip(at, chosen)):
            yield {
                "conv": conv, "task": task, "number": number, "piece": i, "pieces": len(at), "start": start, "finish": finish,
                "tail": tail if i == len(at) - 1 else "", "gaps": gaps, "cost": cost, **{f: facts[f] for f in FACTS},
            }

    def run(batches):
        machine = automaton()
        conv, at = None, []
        out: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if not at or r["conv"] != conv:
                    if at:
                        out.extend(settle(conv, at, facts, steps, tops))
                    conv, at, steps = r["conv"], [], []
                    tops = {0: (0, 0, (0,))}
                    facts = {**dict.fromkeys(FACTS, 0), "numbers": 0, "low": None, "high": None, "last": None}
                for f in FACTS:
                    facts[f] += r[f]
                if r["first"] is not None:
                    if facts["last"] is not None and not pair_legal(facts["last"], r["first"]):
                        facts["illegal"] += 1
                    facts["last"] = r["last"]
                if r["numbers"]:
                    facts["numbers"] += r["numbers"] - (facts["high"] == r["low"])
                    facts["low"] = r["low"] if facts["low"] is None else facts["low"]
                    facts["high"] = r["high"]
                found: dict[int, tuple] = {}
                for w in r["ways"]:
                    begin, end = machine.stacks[w["start"]], machine.stacks[w["end"]]
                    known = tops.get(begin[-1])
                    if known is None or known[2] != begin:
                        continue
                    offer = (known[0] + w["cost"], known[1], w["rank"], begin[-1], w["start"], w["end"])
                    if end[-1] not in found or offer < found[end[-1]]:
                        found[end[-1]] = offer
                order = sorted(found, key=lambda t: found[t][1:3])
                tops = {t: (found[t][0], i, machine.stacks[found[t][5]]) for i, t in enumerate(order)}
                steps.append({t: (found[t][4], found[t][5], found[t][3]) for t in order})
                at.append((r["task"], r["number"]))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if at:
            out.extend(settle(conv, at, facts, steps, tops))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    names = ["conv", "task", "number", *FACTS, "first", "last", "low", "high", "numbers", "ways"]
    return parts.select(*names).repartition("conv").sortWithinPartitions("conv", "task", "number").mapInArrow(run, schema)


def repair_conversations(
    df: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    copies_column: str | None = None,
) -> DataFrame:
    """Repaired conversations in pieces: id, ``piece`` (from 0) of ``pieces``, its ``audit``
    and repaired ``turns`` (role, text), and for the whole conversation ``gaps``, ``blank``,
    ``duplicate``, ``truncated``, ``illegal`` and ``cost``, the same in all its pieces.

    Turns are taken by number, nulls first, those of one number by role, then text. Null roles
    and texts read as one blank, so such a text is blank and such a role outside the grammar, as
    an empty role is. Null ids are one conversation. Equal rows are copies side by side: all but the
    first are duplicates. ``copies_column`` says how often a row stands there; a conversation
    whose rows all have 0 has one piece without turns. An empty table gives an empty result.
    Conversations are cut into pieces after ``PIECE_TURNS`` turns or ``PIECE_CHARACTERS``
    characters, and where their rows lie in two ranges; audit and turns are those of the
    whole, piece after piece. Other columns are not read.
    """
    copies = col(copies_column) if copies_column else F.lit(1)
    told = sorted_turns(df, conv_column, turn_column, role_column, text_column, copies)
    pieces = staged(cut_pieces(told), "pieces")
    gaps = F.when(F.col("numbers") > 0, F.expr("high - low + 1 - numbers")).otherwise(0).cast("long")
    zero = F.lit(0).cast("long")
    done = pieces.where("whole").select(
        "conv", zero.alias("piece"), F.lit(1).cast("long").alias("pieces"), "audit", "turns", gaps.alias("gaps"), *FACTS, "cost"
    )
    parts = pieces.where("not whole")
    plan = fold(parts)
    schema = with_key(
        parts.select("conv").schema, f"piece long, pieces long, audit string, {TURNS}, gaps long, {FAULTS}, cost long"
    )
    arrow = to_arrow_schema(schema)
    given = ["piece", "pieces", "start", "finish", "tail", "gaps", *FACTS, "cost"]

    def run(batches):
        stacks = automaton().stacks
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                found = mend(r["rows"], stacks[r["start"]], stacks[r["finish"]][-1], r["tail"])
                yield pa.RecordBatch.from_pylist([{**r, **found, "cost": r["cost"]}], schema=arrow)

    plan = plan.select("task", "number", *given)
    divided = parts.select("conv", "task", "number", "rows").join(plan, ["task", "number"]).select("conv", "rows", *given).mapInArrow(run, schema)
    both = done.unionByName(divided)
    return both.select(F.col("conv").alias(conv_column), *[c for c in both.columns if c != "conv"])


def conversation_digests(repaired: DataFrame, conv_column: str = "conv_id") -> DataFrame:
    """One row per conversation: its counts, ``cost``, the whole ``audit`` and
    ``repaired_sha256`` of the lines ``role:text``.

    Conversations of one piece are digested where they are. A digest has to read its text
    in order, so those of several pass through one task each, a piece at a time.
    """
    facts = ["gaps", *FACTS, "cost"]
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    rows = repaired.select(col(conv_column).alias("conv"), "piece", "pieces", *facts, "audit", F.array_join(lines, "\n").alias("t"), F.size("turns").alias("n"))
    single = rows.where("pieces = 1").select("conv", *facts, "audit", F.sha2("t", 256).alias("repaired_sha256"))
    schema = single.schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        last, digest, audit, empty = None, None, [], True
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["piece"] == 0:
                    digest, audit, empty = hashlib.sha256(), [], True
                audit.append(r["audit"])
                if r["n"]:
                    digest.update((b"" if empty else b"\n") + r["t"].encode())
                    empty = False
                if r["piece"] == r["pieces"] - 1:
                    out.append({**{f: r[f] for f in ("conv", *facts)}, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    several = rows.where("pieces > 1").repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(run, schema)
    both = single.unionByName(several)
    return both.select(F.col("conv").alias(conv_column), *facts[:-1], "cost", "audit", "repaired_sha256")
