"""Conversation repair against a plain search over all lists of edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from keelson.llm import conversations
from keelson.llm.conversations import BLANK, CUT, DUPLICATE, SOUND

SPACE = "\x20\x09-\x0d"


def brute_damage(rows):
    """The rows after damage, by the definition."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(name.encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def brute_cheapest(rows):
    """``(cost, edits, turns)`` of rows ``(role, text, fault)``, from left to right, all ways kept that differ."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    ways = {"": (0, "", ())}

    def inserted(ways):
        for _ in range(4):
            for state, (cost, edits, turns) in list(ways.items()):
                for role in ("user", "assistant"):
                    if role[0] in follows[state]:
                        new = (cost + 5, edits + "I", (*turns, f"{role}:"))
                        if role[0] not in ways or new < ways[role[0]]:
                            ways[role[0]] = new
        return ways

    for role, text, fault in rows:
        new = {}

        def offer(state, way):
            if state not in new or way < new[state]:
                new[state] = way  # noqa: B023

        for state, (cost, edits, turns) in inserted(dict(ways)).items():
            offer(state, (cost + 2, edits + "D", turns))
            if fault in (SOUND, CUT):
                more = cost + 5 * (fault == CUT)
                if role and role[0] in follows[state]:
                    offer(role[0], (more, edits + "K", (*turns, f"{role}:{text}")))
                for other in ("user", "assistant"):
                    if other[0] in follows[state]:
                        offer(other[0], (more + 1, edits + "R", (*turns, f"{other}:{text}")))
        ways = new
    ends = inserted(dict(ways))
    return min(ends[s] for s in ("", "a") if s in ends)


def brute(rows, ids):
    """What ``repair`` gives, for rows in any order."""
    talks = defaultdict(list, {i: [] for i in ids})
    for conv, turn, role, text in rows:
        talks[conv].append((turn, " " if role is None else role, " " if text is None else text))
    signed = lambda t, seed: (xxhash.xxh64_intdigest(t.encode(), seed) + 2**63) % 2**64
    out = {}
    for conv, turns in talks.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], signed(x[2], 42)))
        seen, known = set(), []
        for _, role, text in turns:
            last = re.search(f"([^{SPACE}])[{SPACE}]*\\Z", text)
            fault = BLANK if not last else DUPLICATE if (role, text) in seen else SOUND if last[1] in ".!?" else CUT
            seen.add((role, text))
            known.append((role, text, fault))
        dated = [t for t, _, _ in turns if t is not None]
        first = [r[:1] for _, r, _ in turns]
        cost, audit, left = brute_cheapest(known)
        count = [sum(f == kind for _, _, f in known) for kind in (BLANK, DUPLICATE, CUT)]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
        gaps = max(dated) - min(dated) + 1 - len(set(dated)) if dated else 0
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest())
    return out


SCHEMA = "conv_id bigint, turn bigint, role string, text string, _id int, kind string, segment string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


def collected(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def random_rows(draw, talks, longest):
    roles = ["user", "assistant", "user", "assistant", "system", "", None, "Umpire", "unit"]
    texts = ["Yes.", "No!", "cut", "", None, " \t", "Why?\n", "Yes. ", "ß "]
    rows = []
    for conv in [None, *range(talks)]:
        for i in range(draw.randint(1, longest)):
            role = draw.choice(roles) if draw.random() < 0.4 else ("user", "assistant")[i % 2]
            text = draw.choice(texts) if draw.random() < 0.4 else f"Turn {i}."
            rows.append((conv, None if draw.random() < 0.05 else i if draw.random() < 0.9 else i + 5, role, text))
    return rows


def test_damage(spark):
    rows = random_rows(random.Random(1), 60, 9)
    got = conversations.damaged(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_damage(rows), key=repr)


def test_repair_against_all_ways(spark):
    draw = random.Random(2)
    rows = random_rows(draw, 80, 9)
    rows += [(500, t, r, x) for _, t, r, x in random_rows(draw, 60, 20)]  # a long one, in several segments
    rows += [(501, i, ("user", "assistant")[i % 2], "Same.") for i in range(400)]
    rows += [(502, 1, "user", "All one row.")] * 300
    draw.shuffle(rows)
    ids = [None, *range(80), 500, 501, 502, 900]
    wanted = spark.createDataFrame([(i,) for i in ids], "conv_id bigint")
    got = collected(conversations.repair(frame(spark, rows).repartition(5), wanted))
    assert got == brute(rows, ids)
    assert got[900] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_turns_give_the_hash(spark):
    rows = random_rows(random.Random(4), 30, 7)
    turns = frame(spark, rows)
    left = defaultdict(list)
    for r in conversations.repaired_turns(turns).orderBy("conv_id", "place").collect():
        left[r.conv_id].append(f"{r.role}:{r.text}")
        assert re.fullmatch("[KRI]", r.edit) and r.place == len(left[r.conv_id])
    for conv, found in collected(conversations.repair(turns)).items():
        assert hashlib.sha256("\n".join(left[conv]).encode()).hexdigest() == found[-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(t[0] for t in left[conv]))


def test_no_turns(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert conversations.repair(conversations.damaged(nothing), nothing.select("conv_id")).count() == 0
    assert conversations.repaired_turns(nothing).columns == ["conv_id", "place", "edit", "turn", "role", "text"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "x", ""]), st.sampled_from([SOUND, SOUND, CUT, BLANK])), max_size=12))
def test_search_finds_the_least(rows):
    ends = {"": 0, "s": 1, "u": 2, "a": 3}
    want = brute_cheapest([(r, "", f) for r, f in rows])[:2]
    joined = conversations.Joined()
    for part in (rows[:5], rows[5:9], rows[9:]):
        ways = [
            {"start": a, "end": b, "cost": found[0], "audit": found[1]}
            for a in ends.values() for b in ends.values() for found in [conversations.cheapest(part, a, b)] if found
        ]
        joined.add({"initials": ["", ""], "turns": [], "illegal": 0, "distinct": 0, "n": 0, "blank": 0,
                    "duplicate": 0, "truncated": 0, "ways": ways})
    assert joined.result() == want


def test_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()]
    from keelson.llm.queries import op13_conversations

    got = collected(op13_conversations(spark, "/root/testdata/sf0.01"))
    assert got == brute(brute_damage(rows), {r[0] for r in rows})
