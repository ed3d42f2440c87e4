"""Operators on odd rows and against brute force."""

import functools
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelson.llm import contamination, language, lines, packing, secret_scan, simhash, substrings, suffix_tree, toxicity
from keelson.llm.common import held_out, key_id
from tests.llm.conftest import TEXTS

FOLDER = "/root/testdata/sf0.001"


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# 7: SimHash


def simple_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(texts):
    prints = [simple_fingerprint(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(texts):
        least[find(i)].append(doc)
    named = {r: min((d for d in ids if d is not None), default=None) for r, ids in least.items()}
    return sorted(((d, p, named[find(i)]) for i, ((d, _), p) in enumerate(zip(texts, prints, strict=True))), key=repr)


def test_simhash_on_odd_rows(odd, empty):
    found = simhash.groups(odd).select(key_id().alias("d"), "fingerprint", "component_id")
    assert sorted(((r.d, r.fingerprint % 2**64, r.component_id) for r in found.collect()), key=repr) == brute_components(TEXTS)
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    # The two texts of id 10 are two components under one id.
    assert kept.count() == len({r.component_id for r in found.collect()}) + 1
    assert simhash.groups(empty).count() == 0 and simhash.keep_one(empty).columns == empty.columns


def test_links_lose_no_pair(spark):
    draw = random.Random(5)
    centres = [draw.getrandbits(64) for _ in range(12)]
    prints = {0, 7}
    for c in centres:
        for _ in range(25):
            x = c
            for _ in range(draw.randint(0, 4)):
                x ^= 1 << draw.randrange(64)
            prints.add(x)
    signed = sorted(x - 2**64 if x >= 2**63 else x for x in prints)
    rows = spark.createDataFrame([(x,) for x in signed], "fingerprint bigint")
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 3}
    for width in (None, 24, 32, 40):
        assert {tuple(r) for r in simhash.links(rows, width).collect()} == want
    assert len(want) > 100


@pytest.mark.parametrize("width", [24, 32, 40])
def test_every_difference_of_three_bits_meets_in_a_key(width):
    """Each set of at most three bits leaves one key of some start untouched, and the chain viable."""
    plans = [
        (sum(((1 << size) - 1) << (16 * ((start + segment) % 4) + low) for segment, low, size in pieces), start)
        for pieces in simhash.PLANS[width]
        for start in range(4)
    ]
    assert {mask.bit_count() for mask, _ in plans} == {width} and len(set(plans)) == len(plans)

    def viable(x, start):
        counts = [(x >> (16 * ((start + i) % 4)) & 0xFFFF).bit_count() for i in range(4)]
        return all(sum(counts[: n + 1]) <= (n + 1) * 3 // 4 for n in range(4))

    for n in range(4):
        for bits in combinations(range(64), n):
            x = sum(1 << b for b in bits)
            assert any(not x & mask and viable(x, start) for mask, start in plans)


def test_wider_keys_for_more_fingerprints():
    assert [simhash.key_width(n) for n in (0, 10**6, 10**9, 10**11)] == [24, 24, 32, 40]


def test_component_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)]
    found = dict(map(tuple, simhash.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


# 8: lines


def brute_lines(texts, least):
    """Windows in order of document, text hash aside: ids of the given texts are different or rows repeat.

    A window whose lines occurred before is joined to their first occurrence, and extended by equal lines.
    """
    order = sorted({(d is None, d or 0, t) for d, t in texts if t is not None})
    split = {key: key[2].split("\n") for key in order}
    seen, gone = {}, defaultdict(set)
    for key in order:
        parts = split[key]
        ends = np.cumsum([len(p) + 1 for p in parts])
        for i in range(len(parts)):
            start = ends[i] - len(parts[i]) - 1
            last = max(j for j in range(len(parts)) if ends[j] - len(parts[j]) - 1 < start + least)
            if ends[last] < start + least:
                continue
            first, at = seen.setdefault(tuple(parts[i : last + 1]), (key, i))
            if (first, at) == (key, i):
                continue
            theirs = split[first]
            for step in (1, -1):
                a, b = i, at
                while 0 <= a < len(parts) and 0 <= b < len(theirs) and parts[a] == theirs[b]:
                    gone[key].add(a)
                    a, b = a + step, b + step
    return {k: "\n".join(p for i, p in enumerate(split[k]) if i not in gone[k]) for k in order}


def test_matched_lines_are_extended(spark):
    body, other = "x" * 47, "y" * 47
    texts = [
        (1, f"{body}\nLes."), (2, f"{body}\nLes."),  # a last line too short for a window of its own
        (3, f"Own line.\n{body}\nLes.\nother"), (4, f"a\nb\n{other}\n\n\nc"), (5, f"b\n{other}\n\n\nd"),
    ]
    found = lines.dedup_lines(spark.createDataFrame(texts, "doc_id bigint, text string"))
    got = {r.doc_id: r.text for r in found.select("row.*").collect()}
    assert got == {1: texts[0][1], 2: "", 3: "Own line.\nother", 4: texts[3][1], 5: "d"}
    want = brute_lines(texts, 48)
    assert got == {d: want[False, d, t] for d, t in texts}


def test_lines_on_odd_rows(odd, empty):
    found = lines.dedup_lines(odd)
    assert found.select("row.*").columns == odd.columns
    by_text = brute_lines(TEXTS, 48)
    got = sorted((r.doc_id, r.text) for r in found.select("row.doc_id", "row.text").collect() if r.doc_id and r.text is not None)
    assert got == sorted((d, by_text[False, d, t]) for d, t in TEXTS if d and t is not None)
    nulls = [r for r in found.select("row.text", "n_lines").collect() if r.text is None]
    assert [r.n_lines for r in nulls] == [0, 0]
    assert lines.dedup_lines(empty).count() == 0


@pytest.mark.parametrize("block", [2, 64])
def test_lines_in_random_runs(spark, monkeypatch, block):
    monkeypatch.setattr(lines, "BLOCK", block)
    draw = random.Random(3)
    pool = ["x" * n + str(n) for n in (0, 1, 3, 9, 20, 30)]
    texts = [(i, "\n".join(draw.choice(pool) for _ in range(draw.randint(1, 14)))) for i in range(60)]
    found = lines.dedup_lines(spark.createDataFrame(texts, "doc_id bigint, text string"), 40)
    want = brute_lines(texts, 40)
    assert {r.doc_id: r.text for r in found.select("row.*").collect()} == {d: want[False, d, t] for d, t in texts}


# 10: benchmark items


def test_contamination_on_odd_rows(odd, empty, items):
    found = collected(contamination.contained(odd, items).select(key_id(), "item_id", "item_shingles", "found"))
    assert found == sorted(
        [(1, 1, 5, 5), (2, 1, 5, 5), (14, None, 3, 3), (15, None, 3, 3), (14, 5, 16, 16), (15, 5, 16, 16)], key=repr
    )
    left = contamination.without_contaminated(odd, items)
    assert left.columns == odd.columns and left.count() == len(TEXTS) - 4
    assert contamination.contained(empty, items).count() == 0
    assert contamination.contained(odd, items.where("false")).count() == 0


def test_contamination_at_the_threshold(spark):
    draw = random.Random(2)
    items, docs, want = [], [], set()
    for i in range(60):
        words = [f"w{draw.randrange(10**9)}" for _ in range(draw.randint(5, 60))]
        items.append((i, " ".join(words)))
        broken = list(words)
        for _ in range(draw.randint(0, 2)):
            broken[draw.randrange(len(words))] = "other"
        docs.append((i, " ".join(["filler"] * 50 + broken + ["end"] * 50)))
        own = {tuple(words[j : j + 5]) for j in range(len(words) - 4)}
        held = {tuple(broken[j : j + 5]) for j in range(len(words) - 4)}
        if len(own & held) >= 0.8 * len(own):
            want.add((i, i))
    found = contamination.contained(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    assert {tuple(r) for r in found.select(key_id(), "item_id").collect()} == want and 10 < len(want) < 60


# 4: secrets


def test_trigram_queries():
    assert secret_scan.trigram_query("AKIA[A-Z0-9]+") == [["aki", "kia"]]
    assert secret_scan.trigram_query("[0-9a-f]+") == [[]]
    assert secret_scan.trigram_query("(abc|xyz)[0-9]+") == [["abc"], ["xyz"]]
    assert secret_scan.trigram_query("ab?c[0-9]*(def)+") == [["def"]]


def test_secrets_on_odd_rows(odd, empty):
    found = secret_scan.scan(odd)
    got = sorted((r.doc_id, [tuple(x) for x in r.found]) for r in found.select("row.doc_id", "found").collect() if r.doc_id)
    want = sorted((d, [(a, i, k, e) for a, i, k, e in secret_scan.brute(t)]) for d, t in TEXTS if d)
    assert got == want and sum(len(x) for _, x in want) >= 5
    assert found.select("row.*").columns == odd.columns
    assert secret_scan.scan(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="passwordtoken=: 'AKI_\"01abcdef", max_size=60))
def test_a_match_satisfies_its_query(text):
    low = text.lower()
    for rule in secret_scan.BASE + secret_scan.MORE:
        if re.search(rule.pattern, text, re.A):
            assert any(all(g in low for g in grams) for grams in secret_scan.trigram_query(rule.pattern))


# 5: packing


def test_packing_round_trip(odd, empty):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(packing.tokenizer_files()[2])
    slow.encode_special_tokens = True
    rows = packing.pack(odd, ids=True).toPandas()
    texts = Counter((d, t) for d, t in TEXTS)
    known = Counter()
    for (d, t), n in texts.items():
        ids = slow.encode(t or "", add_special_tokens=False).ids + [0]
        for at in range(0, len(ids), 1024):
            known[d, at // 1024, tuple(ids[at : at + 1024])] += n
    # The pieces of a window of a document, put together again.
    for key, n in known.items():
        doc, window, ids = key
        own = rows[(rows.doc_id.isna() if doc is None else rows.doc_id == doc) & (rows.start // 1024 == window)]
        bag = Counter((int(r.start) - 1024 * window, tuple(r.ids)) for r in own.itertuples())
        at = 0
        while at < len(ids):
            step = min(len(ids) - at, 1024 if len(ids) == 1024 else 256)
            assert bag[at, ids[at : at + step]] >= n
            at += step
    assert rows.length.sum() == sum(len(k[2]) * n for k, n in known.items())
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows.itertuples())
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() <= 1024
    assert packing.pack(empty).count() == 0


@functools.cache
def tokenizer_file():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_files()[2])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "a", " ", "\n", "'s", "12", "ß", "\U0001f600"]), max_size=12))
def test_ids_are_those_of_the_tokenizer_file(parts):
    text = "".join(parts)
    want = tokenizer_file().encode(text, add_special_tokens=False).ids
    made = packing.Ids(*packing.tokenizer_files())
    assert made(text).tolist() == want
    fast, made.fast = made.fast, None  # as if the faster library had given up
    try:
        assert made(text).tolist() == want
    finally:
        made.fast = fast


def test_packing_keeps_added_tokens(spark):
    docs = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id bigint, text string")
    row = packing.pack(docs, ids=True).first()
    assert row.ids == [64, 50256, 65, 0] and row.doc_tokens == row.length == 4
    assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80))
def test_windows_hold_all_and_overflow_none(sizes):
    sizes = np.array(sizes, np.int64)
    window = packing.windows_of(sizes, 100)
    sums = np.bincount(window, weights=sizes) if len(sizes) else np.zeros(0)
    assert len(window) == len(sizes) and (sums <= 100).all()


def test_differencing_is_near_equal():
    sizes = np.random.default_rng(1).integers(1, 256, 600)
    window, sums = packing.difference(sizes, 70)
    assert sums.sum() == sizes.sum() and sums.max() - sums.min() < 20
    assert (np.bincount(window, weights=sizes, minlength=70) == sums).all()


# 1: suffix tree


def test_scores_on_odd_rows(spark, odd, empty):
    held = held_out(7, 2)
    rows = suffix_tree.score(odd, held).collect()
    count = Counter()
    for d, t in TEXTS:
        if zlib.crc32(b"" if d is None else str(d).encode()) % 7 != 2:
            count.update(suffix_tree.words(t))
    n, v = sum(count.values()), len(count)
    want = sorted(
        (str(d), len(w), sum(count[x] > 0 for x in w), round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6))
        for d, w in ((d, suffix_tree.words(t)) for d, t in TEXTS)
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == want
    assert {r.train_tokens for r in rows} == {n} and all(math.isfinite(r.score) for r in rows)
    assert suffix_tree.score(empty, held).count() == 0
    assert {r.train_tokens for r in suffix_tree.score(odd.where("doc_id = 1"), held_out(1, 0)).collect()} == {0}


def brute_tree(texts, base, depth, least, divergence, smoothing):
    """Retained contexts and their distributions, one context after the other."""
    follow = defaultdict(Counter)
    for x in texts:
        for i in range(len(x)):
            for d in range(1, min(depth, i) + 1):
                follow[tuple(x[i - d : i])][x[i]] += 1
    tree = {(): list(base)}

    def longest(context):
        return next(tree[context[i:]] for i in range(len(context) + 1) if context[i:] in tree)

    for context in sorted(follow, key=len):
        seen, t = follow[context], sum(follow[context].values())
        if t < least:
            continue
        parent = longest(context[1:])
        gain = sum(n / t * math.log(n / t / parent[s]) for s, n in seen.items())
        free = max(1, len(seen) - 1)
        if gain >= divergence and 2 * t * gain >= free + 3 * math.sqrt(2 * free):
            tree[context] = [(seen[s] + smoothing * q) / (t + smoothing) for s, q in enumerate(parent)]
    return tree, longest


@pytest.mark.parametrize("small", [1 << 20, 0])
def test_scores_against_brute_force(spark, small):
    """Both ways of scoring, the broadcast and the joins."""
    draw = random.Random(11)
    pool = [" ".join(draw.choice("the cat dog sat on mat by a red old".split()) for _ in range(4)) for _ in range(12)]
    texts = [(i, " ".join(draw.choice(pool) for _ in range(draw.randint(0, 12)))) for i in range(120)] + [(200, None), (201, "mat")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    held = held_out(7, 2)
    found = {r.doc_id: r for r in suffix_tree.score(docs, held, least=6, small=small).collect()}
    alphabet = suffix_tree.Alphabet(suffix_tree.vocabulary(docs.where(~held)))
    coded = suffix_tree.encoded(docs, alphabet, ~held).collect()
    symbols = {r.doc_id: np.frombuffer(r.symbols, "<u2").tolist() for r in coded}
    train = [symbols[r.doc_id] for r in coded if r.train]
    tree, longest = brute_tree(train, alphabet.base, 3, 6, suffix_tree.DIVERGENCE, suffix_tree.SMOOTHING)
    assert len(tree) > 10 and {len(c) for c in tree} == {0, 1, 2, 3}
    assert all(sum(p) == pytest.approx(1) for p in tree.values())
    for doc, x in symbols.items():
        gain = sum(math.log10(longest(tuple(x[max(0, i - 3) : i]))[s] / alphabet.base[s]) for i, s in enumerate(x))
        assert found[doc].score == pytest.approx(found[doc].base_score + gain, abs=1e-9)


def test_tree_grows_and_helps(spark):
    held, sizes = held_out(7, 2), []
    for folder in (FOLDER, "/root/testdata/sf0.01"):
        docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
        alphabet = suffix_tree.Alphabet(suffix_tree.vocabulary(docs.where(~held)))
        assert alphabet.base.sum() == pytest.approx(1)
        tree = suffix_tree.grow(suffix_tree.encoded(docs, alphabet, ~held).where("train"), alphabet)
        sizes.append(tree.contexts.count())
    assert sizes[1] > 2 * sizes[0] > 0
    rows = suffix_tree.score(docs, held).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_frequent_words_are_symbols_of_their_own(spark):
    """600 words with the same last bytes, each as often as a context must occur, and their followers."""
    pairs = [f"a{i}zz b{i}yy" for i in range(600)]
    draw = random.Random(5)
    texts = [(i, " ".join(draw.sample(pairs, 600))) for i in range(60)]
    texts += [(1000, " ".join(pairs)), (1001, " ".join(f"a{i}zz b{(i + 1) % 600}yy" for i in range(600)))]
    docs, held = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3), F.col("doc_id") >= 1000
    alphabet = suffix_tree.Alphabet(suffix_tree.vocabulary(docs.where(~held)))
    assert alphabet.size == 1202
    found = []
    for alphabet.kind in ("<u2", "<u4"):
        rows = suffix_tree.encoded(docs, alphabet, ~held).cache()
        tree = suffix_tree.grow(rows.where("train"), alphabet)
        assert tree.contexts.where("level = 1").count() >= 600
        for by in (suffix_tree.gains_by_table, suffix_tree.gains_by_blocks):
            found.append({r.doc_id: r.gain for r in by(rows, tree).join(rows, "row").where("doc_id >= 1000").collect()})
    assert all(x == pytest.approx(found[0], rel=1e-12) for x in found)
    assert found[0][1000] > 1000 and found[0][1000] > found[0][1001] + 1000


# 6: substrings


def brute_cut(texts, size):
    data = [(d, (t or "").encode()) for d, t in texts]
    count = Counter(b[i : i + size] for _, b in data for i in range(len(b) - size + 1))
    out = []
    for d, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - size + 1):
            if count[b[i : i + size]] > 1:
                gone[i : i + size] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((str(d), len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("together", [4096, 2])
def test_substrings_against_brute_force(spark, monkeypatch, together):
    monkeypatch.setattr(substrings, "TOGETHER", together)
    draw = random.Random(4)
    pool = ["".join(draw.choice("abé ") for _ in range(draw.randint(40, 160))) for _ in range(12)]
    texts = [(i, "".join(draw.choice(pool) if draw.random() < 0.5 else "".join(draw.choice("xyz") for _ in range(50))
                         for _ in range(draw.randint(1, 6)))) for i in range(40)]
    texts += [(50, "ab" * 300), (51, "a" * 400), (52, None), (53, ""), (None, pool[0]), (54, pool[0])]
    found = substrings.cut_repeats(spark.createDataFrame(texts, "doc_id bigint, text string"), 70)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect())
    assert got == brute_cut(texts, 70)


@pytest.mark.parametrize("together", [64, 3])
def test_substrings_of_crowded_anchors(spark, monkeypatch, together):
    """A passage in many texts: its borders share an anchor, and parts of it end at many places."""
    monkeypatch.setattr(substrings, "TOGETHER", together)
    draw = random.Random(8)
    letters = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passage = letters(150)
    texts = [(i, letters(60) + passage[draw.choice([0, 0, 5, 30]) : draw.choice([150, 150, 149, 120, 90])] + letters(60))
             for i in range(260)]
    texts += [(1000 + i, texts[i % 7][1][draw.randint(0, 9) :]) for i in range(30)]
    found = substrings.cut_repeats(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4), 70)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect())
    assert got == brute_cut(texts, 70)


def test_rows_of_crowded_anchors_grow_in_proportion(spark, monkeypatch):
    """Past the bound on a lot, a border makes a few rows and not one for every window."""
    draw = random.Random(12)
    passage = "".join(draw.choice("abcdefgh ") for _ in range(300))
    noise = lambda: "".join(draw.choice("ijklmnop ") for _ in range(220))
    texts = [(i, noise() + passage + noise()) for i in range(500)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    monkeypatch.setattr(substrings, "TOGETHER", 400)
    seen = []
    stored = substrings.stored
    monkeypatch.setattr(substrings, "stored", lambda df, label: [stored(df, label), seen.append(label)][0])
    rows = substrings.repeated_windows(docs, 200)
    assert "halved-lots" in seen
    assert rows.count() < 30 * len(texts)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                 for r in substrings.cut_repeats(docs, 200).collect())
    assert got == brute_cut(texts, 200)


def test_rows_of_a_constant_text(spark):
    texts = [(1, " " * 300_000), (2, "ab" * 100_000), (3, " " * 900)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert substrings.runs(substrings.keyed(docs).select("_null", "_id", "_hash", "row.text"), 200).count() < 10
    removed = {r.doc_id: r.n_removed for r in substrings.cut_repeats(docs, 200).collect()}
    assert removed == {1: 300_000, 2: 200_000, 3: 900}


def test_substrings_on_odd_rows(odd, empty):
    found = substrings.cut_repeats(odd, 200).collect()
    short = [(d, t) for d, t in TEXTS if d not in (6, 7)]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found if r.doc_id not in (6, 7))
    assert got == brute_cut(short, 200)
    assert {r.n_removed == r.n_bytes for r in found if r.doc_id == 6} == {True}
    assert substrings.cut_repeats(empty).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=40, max_size=40), min_size=1, max_size=12))
def test_blind_trie_sorts(parts):
    data = "".join(parts).encode()
    trie, size = substrings.BlindTrie(data, 40), 40
    for i in range(len(parts)):
        trie.insert(40 * i)
    leaves = [[data[a : a + size] for a in leaf] for leaf in trie.leaves()]
    assert [x for leaf in leaves for x in leaf] == sorted(p.encode() for p in parts)
    assert all(len(set(leaf)) == 1 for leaf in leaves) and len(leaves) == len(set(parts))


def test_long_texts_in_parts(monkeypatch):
    draw = random.Random(6)
    text = "".join(draw.choice("ab ") for _ in range(3000)).encode()
    monkeypatch.setattr(substrings, "CHUNK", 700)
    seen = []
    for data, number, place in substrings._blocks([text, b"short", text[:900]], 100):
        view = np.frombuffer(data, np.uint8)
        ok = (number[99:] == number[: len(view) - 99]) & (place[99:] - place[: len(view) - 99] == 99)
        first, count, _ = substrings.runs_of(view, ok, 100)
        seen += [(number[a], place[a] + i) for a, n in zip(first, count, strict=True) for i in range(n)]
    assert sorted(seen) == [(0, i) for i in range(2901)] + [(2, i) for i in range(801)]


# 2 and 3: classifiers


def test_language_on_odd_rows(odd, empty):
    rows = language.identify(odd, held_out(4, 2)).collect()
    assert len(rows) == len(TEXTS)
    assert {r.lang_pred for r in rows} == {"und", "en"} and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5)} == {"und"}
    assert language.identify(empty, held_out(4, 2)).count() == 0
    nothing = language.identify(odd.where("lang IS NULL"), held_out(4, 2)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs, held_out(4, 2)).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_letters():
    assert language.has_letter("½ x") and language.has_letter("中") and language.has_letter("é")
    assert not any(language.has_letter(t) for t in (None, "", "12 ½ ² _ !", "\U0001f600"))


@pytest.mark.parametrize("count", [1, 2, 4, 7, 12])
def test_codewords_are_apart(count):
    code = language.codewords(count)
    assert code.shape[0] == count
    for i in range(count):
        assert all((code[i] != code[j]).sum() >= max(1, code.shape[1] // 4) for j in range(i))


def test_features_of_a_long_text_in_parts():
    text = "abc déf ghi " * 100_000
    a = language.shares(text)
    raw = (" " + text + " ").encode().translate(language.PLAIN)
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    two = b[:-1] | b[1:] << np.uint32(8)
    three = two[:-1] | b[2:] << np.uint32(16) | np.uint32(1 << 24)
    whole = sum(np.bincount((g * np.uint32(2654435761)) >> np.uint32(20), minlength=language.BUCKETS) for g in (two, three))
    assert np.allclose(a, np.sqrt(whole) / np.sqrt(whole.sum()), atol=1e-6)


def test_toxicity_on_odd_rows(odd, empty, labels):
    rows = toxicity.judge(odd, labels, held_out(5, 0)).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert toxicity.judge(empty, labels, held_out(5, 0)).count() == 0
    assert len({r.score for r in toxicity.judge(odd, labels.where("false"), held_out(5, 0)).collect()}) == 1


def test_swapped_terms_stop_counting(spark):
    """Group names come with insults in the sample; the penalty keeps neutral mentions low."""
    draw = random.Random(8)
    filler = [f"word{i}" for i in range(40)]
    docs, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = draw.sample(filler, 8) + (["vileness"] if toxic and i % 8 else ["awful"] if toxic else [])
        if draw.random() < (0.9 if toxic else 0.05):
            words.append("muslims")
        docs.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    marks = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    ask = spark.createDataFrame([(0, "word1 word2 muslims word3"), (1, "word1 word2 awful word3")], "doc_id bigint, text string")
    fair, plain = (
        [r.score for r in toxicity.with_score(ask, toxicity.learn(docs, marks, fairness=f)).orderBy("doc_id").collect()]
        for f in (50.0, 0.0)
    )
    assert fair[0] < plain[0] and fair[0] < 0.5 < fair[1]


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, marks = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.judge(docs, marks, held_out(5, 0)).where("held_out").join(marks, "doc_id").collect()
    toxic = [r for r in found if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in found if not r.toxic) <= 0.02 * len(found)


def test_short_items_are_found(spark, odd):
    rows = [(7, "Fox JUMPS over"), (8, "river"), (9, "fox over"), (9, "dog near the river"), (10, "jumps over the lazy dog")]
    short = spark.createDataFrame(rows, "item_id bigint, text string")
    found = collected(contamination.contained(odd, short).select(key_id(), "item_id", "item_shingles", "found"))
    assert found == sorted(((d, i, 1, 1) for d in (1, 2) for i in (7, 8, 9, 10)), key=repr)
    assert {r.doc_id for r in contamination.without_contaminated(odd, short).collect()}.isdisjoint({1, 2})


def test_many_secrets_in_a_text(spark):
    """Positions add up over blocks, and in time that grows with the matches."""
    texts = [(n, " ".join(f"é{i:030x}" if i % 3 else "key AKIA" + "Q" * 20 for i in range(n))) for n in (127, 128, 129, 20_000)]
    found = secret_scan.scan(spark.createDataFrame(texts, "doc_id bigint, text string"))
    for r in found.select("row.*", "found").collect():
        assert [tuple(x) for x in r.found] == secret_scan.brute(r.text)
