"""Secrets in texts: a trigram inverted index picks the candidates, the rules' regexes verify them.

From each rule's regex a Boolean query over trigrams is derived: alternatives of sets of trigrams,
one of which every match must contain whole. The postings of those trigrams are intersected per
document; a document is a candidate of a rule if one alternative is complete. A rule from which no
trigram follows is run on every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as op  # the parse tree of a regex
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import KEY, keyed


@dataclass(frozen=True)
class Rule:
    """A regex that Java and Python read alike; a match counts if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base kinds, in the order in which equal starts are listed.
BASE = [
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
]
# Public formats of further secrets.
MORE = [
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("stripe", r"sk_live_[A-Za-z0-9]+", least=32),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]

#: Limits of the derivation. Beyond them a constraint is left out, which only widens the query.
ALTERNATIVES = 64
#: Matches whose positions are summed up in one array.
BLOCK = 128


def _exact(node) -> set[str] | None:
    """All strings a node can match, lower case, or None if they are too many."""
    what, args = node
    if what is op.LITERAL:
        return {chr(args).lower()}
    if what is op.SUBPATTERN:
        return _exact_all(args[-1])
    if what is op.BRANCH:
        parts = [_exact_all(x) for x in args[1]]
        return None if any(x is None for x in parts) else set().union(*parts)
    if what is op.IN and all(kind is op.LITERAL for kind, _ in args):
        return {chr(c).lower() for _, c in args}
    if what is op.MAX_REPEAT and args[1] == 1:
        inner = _exact_all(args[2])
        return None if inner is None else inner | ({""} if args[0] == 0 else set())
    return None


def _exact_all(nodes) -> set[str] | None:
    found = {""}
    for node in nodes:
        more = _exact(node)
        if more is None or len(found) * len(more) > ALTERNATIVES:
            return None
        found = {a + b for a, b in product(found, more)}
    return found


def _both(left: set, right: set) -> set:
    joined = {a | b for a, b in product(left, right)}
    least = {x for x in joined if not any(y < x for y in joined)}
    return least if len(least) <= ALTERNATIVES else left


def _query(nodes) -> set[frozenset[str]]:
    query, runs = {frozenset()}, {""}

    def flush():
        options = {frozenset(x[i : i + 3] for i in range(len(x) - 2)) for x in runs}
        return query if frozenset() in options else _both(query, options)

    for node in nodes:
        more = _exact(node)
        if more is not None and len(runs) * len(more) <= ALTERNATIVES:
            runs = {a + b for a, b in product(runs, more)}
            continue
        query, runs = flush(), {""}
        what, args = node
        if what is op.SUBPATTERN:
            query = _both(query, _query(args[-1]))
        elif what is op.MAX_REPEAT and args[0] > 0:
            query = _both(query, _query(args[2]))
        elif what is op.BRANCH:
            query = _both(query, set().union(*(_query(x) for x in args[1])))
    return flush()


def trigram_query(pattern: str) -> list[list[str]]:
    """Alternatives of trigrams (lower case) that a match needs; ``[[]]`` if none follows."""
    return sorted(sorted(x) for x in _query(parser.parse(pattern)))


def postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """``trigram, _null, _id, _hash``: which of the given trigrams each text holds, any case."""
    low = rows.select(*KEY, F.lower("text").alias("low"))
    held = F.array(*(F.when(F.contains(F.col("low"), F.lit(x)), F.lit(x)) for x in trigrams))
    return low.select(*KEY, F.explode(held).alias("trigram")).where("trigram IS NOT NULL")


def candidates(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """``_null, _id, _hash, kinds``: the rules with trigrams that may match a document."""
    spark = rows.sparkSession
    terms = [
        (rule.kind, n, len(grams), gram)
        for rule in rules
        for n, grams in enumerate(trigram_query(rule.pattern))
        for gram in grams
    ]
    wanted = spark.createDataFrame(terms, "kind string, alternative int, size int, trigram string")
    # Repeated rows bring a posting more than once.
    found = postings(rows, sorted({x[3] for x in terms})).distinct()
    # As many rows as the rules have trigrams: bounded by the rules.
    met = found.join(F.broadcast(wanted), "trigram").groupBy(*KEY, "kind", "alternative")
    whole = met.agg(F.count("*").alias("n"), F.first("size").alias("size")).where("n = size")
    return whole.groupBy(*KEY).agg(F.collect_set("kind").alias("kinds"))


def steps(text: Column, rule: Rule) -> Column:
    """The matches of one rule in turn: ``gap`` before it, its ``own`` length and the ``counted`` one.

    Java's regex gives the matches and, by splitting, what lies between them.
    """
    pattern = F.lit(rule.pattern)
    size = lambda parts: F.transform(parts, lambda x: F.length(x))
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    zipped = F.arrays_zip(
        size(F.split(text, rule.pattern, -1)).alias("gap"), size(whole).alias("own"), size(counted).alias("counted")
    )
    return F.when(text.rlike(rule.pattern), F.filter(zipped, lambda x: x["own"].isNotNull()))


def spans(found: str, rule: Rule, order: int) -> Column:
    """``(start, order, kind, end)`` of the ``steps`` of a rule that are long enough: code points, end exclusive.

    Lengths in turn sum up to the positions. An array that grows is copied at every entry, so sums run
    in blocks of ``BLOCK``, from what the blocks before them add up to: time grows with the matches,
    and with the square of the blocks alone. ``found`` is a stored column, as lambdas refer to it.
    """
    none = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    number = F.sequence(F.lit(0), F.expr(f"CAST(greatest(size({found}) - 1, 0) div {BLOCK} AS INT)"))
    blocks = F.transform(number, lambda j: F.slice(F.col(found), j * BLOCK + 1, F.lit(BLOCK)))
    length = lambda x: x["gap"] + x["own"]
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda at, x: at + length(x)))
    begins = F.aggregate(
        totals,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"],
    )

    def placed(block: Column, begin: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(begin.alias("at"), none.alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + length(x)).alias("at"),
                F.when(
                    x["counted"] >= rule.least,
                    F.concat(
                        acc["out"],
                        F.array(
                            F.struct(
                                (acc["at"] + x["gap"]).alias("start"),
                                F.lit(order).alias("order"),
                                F.lit(rule.kind).alias("kind"),
                                (acc["at"] + length(x)).alias("end"),
                            )
                        ),
                    ),
                ).otherwise(acc["out"]).alias("out"),
            ),
            lambda acc: acc["out"],
        )

    each = F.arrays_zip(blocks.alias("block"), begins.alias("begin"))
    whole = F.flatten(F.transform(each, lambda z: placed(z["block"], z["begin"])))
    return F.when(F.col(found).isNotNull(), whole).otherwise(none)


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """``row`` with the columns of ``docs`` and ``found``, its secrets sorted by start, then rule.

    A null text holds none, like an empty one; texts are read whole. Repeated rows are found alike.
    An empty table gives an empty one.
    """
    rules = BASE + MORE if rules is None else rules
    rows = keyed(docs).withColumn("text", F.coalesce("row.text", F.lit("")))
    indexed = [r for r in rules if trigram_query(r.pattern) != [[]]]
    joined = rows.withColumn("kinds", F.lit(None).cast("array<string>"))
    if indexed:
        joined = rows.join(candidates(rows.select(*KEY, "text"), indexed), list(KEY), "left")
    held = [
        F.when(F.array_contains("kinds", rule.kind), steps(F.col("text"), rule))
        if rule in indexed
        else steps(F.col("text"), rule)
        for rule in rules
    ]
    told = joined.select("row", *(column.alias(f"_steps{i}") for i, column in enumerate(held)))
    parts = [spans(f"_steps{i}", rule, i) for i, rule in enumerate(rules)]
    return told.select("row", F.sort_array(F.flatten(F.array(*parts))).alias("found"))


def brute(text: str | None, rules: list[Rule] | None = None) -> list[tuple[int, int, str, int]]:
    """The same for one text, by Python's ``re`` on all of it: for tests."""
    out = []
    for i, rule in enumerate(BASE + MORE if rules is None else rules):
        for m in re.finditer(rule.pattern, text or "", re.A):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), i, rule.kind, m.end()))
    return sorted(out)
