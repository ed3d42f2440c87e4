"""The queries of this subpackage over the standard tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.llm import (
    contamination,
    conversations,
    language,
    lines,
    mixing,
    neighbours,
    packing,
    secret_scan,
    simhash,
    substrings,
    suffix_tree,
    toxicity,
    whitening,
)
from keelson.llm.common import held_out, key_id
from keelson.sources import table

_queries: dict = {}
_oracles: dict[str, str] = {}


def query(sql: str | None = None):
    def add(build):
        _queries[build.__name__] = build
        if sql is not None:
            _oracles[build.__name__] = sql
        return build

    return add


def queries() -> dict:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)


def documents(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text")


@query()
def op7_simhash(spark, folder):
    found = simhash.groups(documents(spark, folder), length=3)
    return found.select(
        key_id().alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


MIN_CHARS = 48

LINES_SQL = f"""
    WITH docs AS (
        SELECT doc_id, string_split(text, chr(10)) AS parts, text FROM documents),
    lines AS (
        SELECT doc_id, line, parts[line] AS value, length(parts[line]) + 1 AS size
        FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS line FROM docs)),
    ends AS (
        SELECT *, sum(size) OVER (PARTITION BY doc_id ORDER BY line) AS stop FROM lines),
    placed AS (
        SELECT *, stop - size AS start FROM ends),
    runs AS (
        SELECT doc_id, line, start,
               max(line) OVER ahead AS last, max(stop) OVER ahead AS till,
               string_agg(value, chr(10)) OVER ahead AS run
        FROM placed
        WINDOW ahead AS (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND {MIN_CHARS - 1} FOLLOWING)),
    -- Every later window beside the first one with the same lines.
    met AS (
        SELECT doc_id, line, first_value(doc_id) OVER earliest AS first_id, first_value(line) OVER earliest AS first_line,
               row_number() OVER earliest AS nth
        FROM runs WHERE till >= start + {MIN_CHARS}
        WINDOW earliest AS (PARTITION BY run ORDER BY doc_id, line)),
    matched AS (SELECT doc_id, line, first_id, line - first_line AS ahead FROM met WHERE nth > 1),
    -- To both sides of a match: all equal lines of the two texts in that position, in rows without a gap.
    aligned AS (SELECT DISTINCT doc_id, first_id, ahead FROM matched),
    equal AS (
        SELECT p.doc_id, p.first_id, p.ahead, a.line,
               a.line - row_number() OVER (PARTITION BY p.doc_id, p.first_id, p.ahead ORDER BY a.line) AS island
        FROM aligned p JOIN lines a ON a.doc_id = p.doc_id
             JOIN lines b ON b.doc_id = p.first_id AND b.line = a.line - p.ahead AND b.value = a.value),
    gone AS (
        SELECT DISTINCT doc_id, first_id, ahead, island FROM equal JOIN matched USING (doc_id, first_id, ahead, line)),
    cut AS (SELECT DISTINCT doc_id, line FROM equal JOIN gone USING (doc_id, first_id, ahead, island)),
    kept AS (
        SELECT l.doc_id, string_agg(l.value, chr(10) ORDER BY l.line) AS text, count(*) AS n
        FROM lines l ANTI JOIN cut c ON l.doc_id = c.doc_id AND l.line = c.line GROUP BY l.doc_id)
"""


@query(f"""
    {LINES_SQL}
    SELECT d.doc_id, coalesce(len(parts), 0) AS n_lines, coalesce(len(parts), 0) - coalesce(n, 0) AS n_removed,
           CASE WHEN d.text IS NULL THEN NULL ELSE sha256(coalesce(k.text, '')) END AS kept_sha256
    FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
""")
def op8_line_dedup(spark, folder):
    found = lines.dedup_lines(documents(spark, folder), MIN_CHARS)
    kept = F.sha2(F.col("row.text").cast("binary"), 256)
    return found.select("row.doc_id", "n_lines", "n_removed", kept.alias("kept_sha256"))


WORDS_SQL = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"


@query(f"""
    WITH item_words AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
    doc_words AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
    -- An item with fewer words than a shingle is its own only shingle.
    lengths AS (SELECT DISTINCT least(len(w), 5) AS k FROM item_words WHERE len(w) > 0),
    items AS (
        SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2),
                   lambda i: array_to_string(w[i : i + least(len(w), 5) - 1], ' '))) AS shingle
        FROM item_words WHERE len(w) > 0),
    held AS (
        SELECT DISTINCT * FROM (
            SELECT doc_id, unnest(list_transform(range(1, len(w) - k + 2),
                       lambda i: array_to_string(w[i : i + k - 1], ' '))) AS shingle
            FROM doc_words, lengths WHERE len(w) >= k)
        WHERE shingle IN (SELECT shingle FROM items)),
    sizes AS (SELECT item_id, count(*) AS item_shingles FROM items GROUP BY item_id)
    SELECT doc_id, item_id, item_shingles, count(*) AS found, count(*) / item_shingles AS containment
    FROM held JOIN items USING (shingle) JOIN sizes USING (item_id)
    GROUP BY doc_id, item_id, item_shingles HAVING count(*) >= item_shingles * CAST(0.8 AS DOUBLE)
""")
def op10_contamination(spark, folder):
    items = table(spark, folder, "benchmark")
    found = contamination.contained(documents(spark, folder), items, threshold=0.8, length=5)
    return found.select(key_id().alias("doc_id"), "item_id", "item_shingles", "found", "containment")


@query()
def op4_secret_scan(spark, folder):
    found = secret_scan.scan(documents(spark, folder))
    base = [rule.kind for rule in secret_scan.BASE]
    said = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )
    of = lambda *kinds: F.filter("found", lambda x: x["kind"].isin(*kinds))
    return found.select(
        "row.doc_id",
        *(F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in base),
        F.sha2(said(of(*base)).cast("binary"), 256).alias("base_sha256"),
        said(F.col("found")).alias("spans"),
    )


@query()
def op5_packing(spark, folder):
    return packing.pack(documents(spark, folder), capacity=1024)


@query()
def op1_suffix_tree(spark, folder):
    return suffix_tree.score(documents(spark, folder), held_out(7, 2))


@query()
def op6_suffix_array(spark, folder):
    return substrings.cut_repeats(documents(spark, folder), size=200).drop("kept")


@query()
def op2_language(spark, folder):
    return language.identify(table(spark, folder, "documents"), held_out(4, 2))


@query()
def op3_toxicity(spark, folder):
    return toxicity.judge(documents(spark, folder), table(spark, folder, "labels"), held_out(5, 0))


@query()
def op9_neighbours(spark, folder):
    return neighbours.nearest(table(spark, folder, "embeddings"), k=20, every=20)


@query()
def op11_whitening(spark, folder):
    return whitening.whitened(table(spark, folder, "embeddings"), most=4)


@query(r"""
    WITH docs AS (
        SELECT d.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
               -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 13)
                   AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / coalesce(weight, 1.0::DOUBLE) AS draw
        FROM documents d LEFT JOIN (SELECT doc_id, max(1.0::DOUBLE + quality) AS weight FROM labels GROUP BY doc_id) q
            ON d.doc_id IS NOT DISTINCT FROM q.doc_id),
    sizes AS (SELECT source, CAST(sum(size) AS HUGEINT) AS s FROM docs GROUP BY source),
    ranked AS (
        SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS HUGEINT) AS w FROM sizes),
    ordered AS (
        SELECT *, sum(s) OVER () AS t, sum(w) OVER () AS h,
               coalesce(sum(3 * s) OVER before, 0) AS tb, coalesce(sum(w) OVER before, 0) AS hb
        FROM ranked
        WINDOW before AS (ORDER BY CAST(3 * s AS DOUBLE) / CAST(w AS DOUBLE), source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    marked AS (SELECT *, 3 * s * (h - hb) <= (t - tb) * w AS capped FROM ordered),
    level AS (
        SELECT max(t) - coalesce(sum(3 * s) FILTER (WHERE capped), 0) AS remaining,
               max(h) - coalesce(sum(w) FILTER (WHERE capped), 0) AS weights FROM marked),
    targets AS (
        SELECT source, CAST(s AS BIGINT) AS source_size,
               CASE WHEN capped THEN CAST(3 * s AS DOUBLE)
                    ELSE CAST(w AS DOUBLE) * CAST(remaining AS DOUBLE) / CAST(greatest(weights, 1) AS DOUBLE) END AS target
        FROM marked, level),
    placed AS (
        SELECT docs.*, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS budget,
               CAST(coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY draw, doc_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
        FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source)
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(
               CASE WHEN source_size = 0 THEN 0
                    ELSE budget // source_size * size + greatest(0, least(size, budget % source_size - before)) END
               AS BIGINT) AS taken
    FROM placed
""")
def op12_mixing(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", (F.lit(1.0) + F.col("quality")).alias("weight"))
    mixed = mixing.mix(table(spark, folder, "documents"), labels, weights=(1, 2, 3), most=3)
    return mixed.select(key_id().alias("doc_id"), "size", "source_size", "target", "taken")


@query()
def op13_conversations(spark, folder):
    turns = table(spark, folder, "conversations")
    return conversations.repair(conversations.damaged(turns), ids=turns.select("conv_id"))
