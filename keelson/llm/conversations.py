"""Repair of conversation structure by depth-first branch-and-bound.

A repaired conversation is empty or has an optional system turn and then pairs of user and assistant.
Edits keep, rerole, delete or insert turns, each at a cost; the cheapest list of edits is wanted, of
equal ones the least as text. The search goes down an explicit stack of prefixes. Bounds from below
on what is left of the conversation cut prefixes that cannot reach the best list so far (cost and
edits), and a table for each node, a place and a state, cuts those that an earlier prefix reaches
at least as well, until nothing is open.

Conversations are not bounded, so turns are put in order over ranges, equal ones as one row with a
count, and cut into segments. A segment is solved for every state it may begin and end in, which are
four; the segments of a conversation are then joined from left to right, and only that pass, which
keeps a few running numbers and lists of letters, reads the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stored

#: A conversation, and the order of its turns. None of these is ever null.
CONV, ORDER = ("_null", "_id"), ("_dated", "_turn", "_role", "_h1", "_h2")
#: Turns (different ones) of a segment at most.
SEGMENT = 128
#: What a conversation may have come to: nothing yet, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn with a given initial; what is missing is not allowed.
AFTER = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
#: The role that a reroled or inserted turn takes in a state.
NEXT = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
FOLLOWS = {state: AFTER[state, role[0]] for state, role in NEXT.items()}
#: Costs of the edits; an undeleted truncated turn adds the last.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SOUND, BLANK, DUPLICATE, CUT = range(4)
LEGAL = ("su", "ua", "au")
FAR = 1 << 60


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after damage by CRC-32 of ``conv_id:turn``, modulo 20.

    0 drops a turn, 1 empties it, 2 takes its sentence ends, 3 repeats it, 4 sets its role to user.
    A null is one blank, in the hashed text and as role or text; ids and turns stay null.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), hit.alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("hit") == 3, 2).otherwise(1)))
    return rows.where("hit != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_")).drop("_")


def _keys(turns: DataFrame) -> DataFrame:
    said = lambda c: F.coalesce(F.col(c), F.lit(" "))
    return turns.select(
        F.col("conv_id").isNull().alias(CONV[0]), F.coalesce("conv_id", F.lit(0)).alias(CONV[1]),
        F.col("turn").isNotNull().alias("_dated"), F.coalesce("turn", F.lit(0)).cast("bigint").alias("_turn"),
        said("role").alias("_role"), F.xxhash64(said("text")).alias("_h1"),
        F.xxhash64(said("text"), F.lit(1)).alias("_h2"), said("text").alias("text"),
    )


def _faulty(rows: DataFrame) -> DataFrame:
    """One row for each different turn: its keys, ``fault`` and how often it occurs, ``copies``."""
    last: Column = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    own = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(CUT)
    each = stored(
        rows.select(*CONV, *ORDER, own.alias("fault")).groupBy(*CONV, *ORDER, "fault").agg(F.count("*").alias("copies")),
        "turns",
    )
    same = (*CONV, *ORDER[2:])
    when = F.struct(*ORDER[:2])
    seen = each.where(F.col("fault") != BLANK).groupBy(*same).agg(F.min(when).alias("first"), F.max(when).alias("last"))
    seen = stored(seen.where("first != last").drop("last"), "repeated-turns")
    again = F.col("first").isNotNull() & (F.col("fault") != BLANK) & (F.col("first") != when)
    return stored(
        each.join(seen, list(same), "left").select(
            *CONV, *ORDER, F.when(again, DUPLICATE).otherwise(F.col("fault")).alias("fault"), "copies"
        ),
        "faults",
    )


def _bounds(rows: list[tuple[str, int]], end: int) -> list[list[int]]:
    """For each suffix of ``(initial, fault)`` and state: what leads to ``end`` costs at least that.

    The bound looks at costs alone, from the last row back, and not at the lists of edits.
    """
    low = [[0 if s == end else FAR for s in range(4)]]
    for initial, fault in reversed(rows):
        behind, here = low[-1], []
        for state in range(4):
            least = DELETE + behind[state]
            if fault in (SOUND, CUT):
                more = TRUNCATED if fault == CUT else 0
                least = min(least, more + REROLE + behind[FOLLOWS[state]])
                if (state, initial) in AFTER:
                    least = min(least, more + KEEP + behind[AFTER[state, initial]])
            here.append(least)
        for state in (USER, ASSISTANT, USER, SYSTEM, START):
            here[state] = min(here[state], INSERT + here[FOLLOWS[state]])
        low.append(here)
    return low[::-1]


def cheapest(rows: list[tuple[str, int]], start: int, end: int, low: list | None = None) -> tuple[int, str] | None:
    """The least ``(cost, edits)`` that lead from state ``start`` over all ``rows`` to state ``end``.

    Inserts come before a row; those behind the last row of a conversation are up to the caller.
    """
    n, low = len(rows), _bounds(rows, end) if low is None else low
    best: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        least = cost + low[at][state]
        if least >= FAR or best is not None and (least, audit) > (best[0], best[1][: len(audit)]):
            continue
        old = reached.get((at, state))
        if old is not None and old <= (cost, audit):
            continue
        reached[at, state] = (cost, audit)
        if at == n:
            if state == end and (best is None or (cost, audit) < best):
                best = (cost, audit)
            continue
        initial, fault = rows[at]
        follows = FOLLOWS[state]
        children = [(at + 1, state, cost + DELETE, audit + "D"), (at, follows, cost + INSERT, audit + "I")]
        if fault in (SOUND, CUT):
            more = cost + (TRUNCATED if fault == CUT else 0)
            if (state, initial) in AFTER:
                children.append((at + 1, AFTER[state, initial], more + KEEP, audit + "K"))
            children.append((at + 1, follows, more + REROLE, audit + "R"))
        # The most promising is on top of the stack, of equal ones the least as text.
        stack += sorted(children, key=lambda x: (x[2] + low[x[0]][x[1]], x[3]), reverse=True)
    return best


#: What a segment adds to its conversation, for Spark and for Arrow.
ADDED = (
    "segment struct<n: bigint, blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint, "
    "initials: array<string>, turns: array<bigint>, distinct: bigint, "
    "ways: array<struct<start: bigint, end: bigint, cost: bigint, audit: string>>>"
)
WAY = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])
ADDED_TYPE = pa.struct(
    [(c, pa.int64()) for c in ("n", "blank", "duplicate", "truncated", "illegal")]
    + [("initials", pa.list_(pa.string())), ("turns", pa.list_(pa.int64())), ("distinct", pa.int64()), ("ways", pa.list_(WAY))]
)


def _solved(rows: list[dict], begins: bool) -> dict:
    """What a segment of sorted rows adds to its conversation."""
    known = [(r["_role"][:1], r["fault"]) for r in rows]
    flat, extra, count = [], 0, dict.fromkeys((BLANK, DUPLICATE, CUT), 0)
    for (initial, fault), r in zip(known, rows, strict=True):
        more = r["copies"] - 1
        flat.append((initial, fault))
        if fault:
            count[fault] += 1
        count[BLANK if fault == BLANK else DUPLICATE] += more
        extra += more
    pairs = sum(a[0] + b[0] not in LEGAL for a, b in zip(flat, flat[1:]))
    turns = [r["_turn"] for r in rows if r["_dated"]]
    ways = []
    for end in range(4):
        low = _bounds(flat, end)
        for start in (START,) if begins else range(4):
            found = cheapest(flat, start, end, low)
            if found is None:
                continue
            cost, letters = found[0] + DELETE * extra, iter(found[1])
            audit = []
            for r in rows:  # the copies of a turn are deleted behind it
                for letter in letters:
                    audit.append(letter)
                    if letter != "I":
                        break
                audit.append("D" * (r["copies"] - 1))
            ways.append({"start": start, "end": end, "cost": cost, "audit": "".join(audit)})
    return {
        "n": len(rows) + extra, "blank": count[BLANK], "duplicate": count[DUPLICATE], "truncated": count[CUT],
        "illegal": pairs + extra, "initials": [known[0][0], known[-1][0]],
        "turns": [turns[0], turns[-1]] if turns else [], "distinct": len(set(turns)), "ways": ways,
    }


def segments(turns: DataFrame) -> DataFrame:
    """Solved segments of ``turns`` (of ``_keys``): keys of their first row and what they add."""
    faulty = _faulty(turns)
    order = (*CONV, *ORDER)
    kinds = dict(faulty.dtypes)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is before the first row of a task is not known: it may go on with a conversation.
        held, begins, arrow = [], False, None

        def done(out: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(out, schema=arrow)

        def segment() -> dict:
            return {c: held[0][c] for c in order} | {"segment": _solved(held, begins)}

        for batch in batches:
            arrow = pa.schema([*(batch.schema.field(c) for c in order), pa.field("segment", ADDED_TYPE)])
            out = []
            for row in batch.to_pylist():
                other = bool(held) and any(row[c] != held[-1][c] for c in CONV)
                if other or len(held) == SEGMENT:
                    out.append(segment())
                    held, begins = [], other
                held.append(row)
            yield done(out)
        if held:
            yield done([segment()])

    schema = ", ".join(f"{c} {kinds[c]}" for c in order) + f", {ADDED}"
    dealt = faulty.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(dealt.mapInArrow(solve, schema), "segments")


class Joined:
    """The segments of one conversation, joined from left to right.

    For each state the least cost and edits that lead to it. The lists of edits are chains of
    pieces; none of them begins another, so an order of the states' lists orders what follows too.
    """

    def __init__(self):
        self.ways = {START: (0, 0, None)}  # state: cost, rank, chain
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.initial, self.first, self.last = None, None, None

    def add(self, segment: dict) -> None:
        first, last = segment["initials"]
        self.illegal += segment["illegal"] + (self.initial is not None and self.initial + first not in LEGAL)
        self.initial = last
        if segment["turns"]:
            low, high = segment["turns"]
            self.distinct += segment["distinct"] - (self.last == low)
            self.first, self.last = low if self.first is None else self.first, high
        for name in ("n", "blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + segment[name])
        found: dict = {}
        for way in segment["ways"]:
            if way["start"] in self.ways:
                cost, rank, chain = self.ways[way["start"]]
                option = (cost + way["cost"], rank, way["audit"], chain)
                if way["end"] not in found or option[:3] < found[way["end"]][:3]:
                    found[way["end"]] = option
        ranked = sorted(found, key=lambda s: found[s][1:3])
        self.ways = {s: (found[s][0], i, (found[s][3], found[s][2])) for i, s in enumerate(ranked)}

    def result(self) -> tuple[int, str]:
        """The least cost and edits of the whole, with what has to be inserted at the end."""
        missing = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
        ends = [(c + INSERT * missing[s], rank, chain, missing[s]) for s, (c, rank, chain) in self.ways.items()]
        cost, _, chain, behind = min(ends, key=lambda x: x[:2])
        pieces = ["I" * behind]
        while chain is not None:
            chain, piece = chain
            pieces.append(piece)
        return cost, "".join(reversed(pieces))

    def summary(self) -> dict:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        cost, audit = self.result()
        return {
            "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": self.illegal, "cost": cost, "audit": audit,
        }


def _edited(audit: Iterator[str], state: int, row: dict | None) -> Iterator[tuple[str, int, str | None, str]]:
    """``(edit, state after it, role, text)`` up to the edit that takes ``row``, or of all that is left."""
    for letter in audit:
        if letter == "I":
            state = FOLLOWS[state]
            yield letter, state, "user" if state == USER else "assistant", ""
            continue
        if letter == "D":
            yield letter, state, None, ""
            return
        role = NEXT[state] if letter == "R" else row["_role"]
        state = AFTER[state, role[:1]]
        yield letter, state, role, row["text"]
        return


def _repaired(turns: DataFrame, ids: DataFrame | None, work) -> DataFrame:
    """The last pass: ``work(conv_id, joined)`` is shown each edit of a conversation and makes the rows."""
    keyed = _keys(turns)
    solved = segments(keyed)
    marks = solved.select(*CONV).limit(0) if ids is None else ids.select(
        F.col("conv_id").isNull().alias(CONV[0]), F.coalesce("conv_id", F.lit(0)).alias(CONV[1])
    ).distinct()
    # By kind: the conversation's name, its segments, its turns with their texts.
    every = (
        marks.withColumn("kind", F.lit(0))
        .unionByName(solved.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        .unionByName(keyed.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, joined, state, audit, own, arrow = None, None, START, None, None, None
        out: list[dict] = []

        def close() -> None:
            letters = iter(joined.result()[1]) if audit is None else audit
            for edit in _edited(letters, state, None):
                out.extend(own.turn(*edit, None))
            out.extend(own.end())

        def done() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist(out, schema=arrow)
            out.clear()
            return made

        for batch in batches:
            arrow = pa.schema([pa.field("conv_id", batch.schema.field(CONV[1]).type), *work.fields])
            for row in batch.to_pylist():
                key = (row[CONV[0]], row[CONV[1]])
                if key != current:
                    if current is not None:
                        close()
                    current, joined, state, audit = key, Joined(), START, None
                    own = work(None if key[0] else key[1], joined)
                if row["kind"] == 1:
                    joined.add(row["segment"])
                elif row["kind"] == 2:
                    audit = iter(joined.result()[1]) if audit is None else audit
                    for edit in _edited(audit, state, row):
                        state = edit[1]
                        out.extend(own.turn(*edit, row))
            yield done()
        if current is not None:
            close()
            yield done()

    said = {pa.int64(): "long", pa.string(): "string"}
    kind = dict(turns.dtypes)["conv_id"]
    schema = ", ".join([f"conv_id {kind}", *(f"{name} {said[t]}" for name, t in work.fields)])
    columns = [*CONV, "kind", *ORDER]
    return every.repartition(*CONV).sortWithinPartitions(*columns).mapInArrow(run, schema)


class _Digest:
    """One row for a conversation: what is wrong with it, the edits, and a hash of what they leave."""

    fields = (
        *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        ("audit", pa.string()), ("repaired_sha256", pa.string()),
    )

    def __init__(self, conv_id, joined: Joined):
        self.conv_id, self.joined, self.hash, self.any = conv_id, joined, hashlib.sha256(), False

    def turn(self, edit, state, role, text, row) -> list[dict]:
        if role is not None:
            self.hash.update((("\n" if self.any else "") + f"{role}:{text}").encode())
            self.any = True
        return []

    def end(self) -> list[dict]:
        return [{"conv_id": self.conv_id} | self.joined.summary() | {"repaired_sha256": self.hash.hexdigest()}]


class _Turns:
    """A row for each turn that the edits leave."""

    fields = (
        ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
    )

    def __init__(self, conv_id, joined: Joined):
        self.conv_id, self.place = conv_id, 0

    def turn(self, edit, state, role, text, row) -> list[dict]:
        if role is None:
            return []
        self.place += 1
        own = row["_turn"] if edit != "I" and row is not None and row["_dated"] else None
        return [{"conv_id": self.conv_id, "place": self.place, "edit": edit, "turn": own, "role": role, "text": text}]

    def end(self) -> list[dict]:
        return []


def repair(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``, one row a conversation.

    Turns go by ``turn``, null first; turns of one number by role and then by a hash of the text, so
    equal rows are neighbours. A null role or text is one blank, a null ``conv_id`` a conversation
    like any other. ``blank``, ``duplicate`` and ``truncated`` count turns by their first fault;
    ``illegal`` counts neighbours whose roles may not follow each other. ``ids (conv_id)`` names
    conversations that are reported even without turns: zeros, no edits, the hash of nothing. An
    empty table gives an empty one. Other columns are not looked at. Texts and conversations of any
    length are taken whole; the texts of one conversation pass through one task, as their hash needs
    them in a row, but are not held there.
    """
    return _repaired(turns, ids, _Digest)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, place, edit, turn, role, text``: the turns of the repaired conversations, in order of ``place``.

    Rows are taken as in ``repair``; an inserted turn has no ``turn`` and an empty text.
    """
    return _repaired(turns, None, _Turns)
