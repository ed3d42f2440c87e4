"""Item-to-item cosine similarity over ``(user, item, rating)`` rows.

Two items are compared over the users who rated both:
``score = sum(x*y) / (sqrt(sum(x*x)) * sqrt(sum(y*y)))``, ``strength`` = number of such users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions import other_side, safe_ratio
from keelson.operators.ranking import top_k, top_k_per_group
from keelson.session import keep

# Largest number of items of one user that a work unit pairs with each other. It bounds a
# unit's memory, not the result: users with more items are split into several units.
UNIT_ITEMS = 256
# Pairs that a task counts where each pair is moved in a list. The pairs of an item with four times as
# many are dealt to all tasks.
TASK_PAIRS = 1 << 22


def unique_ratings(ratings: DataFrame) -> DataFrame:
    """One row per (user, item), the highest rating, so that the sums count each user once."""
    clean = ratings.where("user IS NOT NULL AND item IS NOT NULL AND rating IS NOT NULL")
    return clean.groupBy("user", "item").agg(F.max("rating").cast("double").alias("rating"))


def item_pairs(ratings: DataFrame, min_strength: int = 1) -> DataFrame:
    """``(item_x, item_y, sum_xx, sum_xy, sum_yy, strength)`` for co-rated items, ``item_x < item_y``.

    A self-join cut into units of bounded size, then one aggregate. The usual user is one unit. A user
    with more than ``UNIT_ITEMS`` items has them hashed to blocks and one unit for every two blocks, so
    the pairs of the hottest user are spread over the cluster. ``ratings`` are unique per (user, item).
    The full table is quadratic in a user's items by nature; with ``min_strength`` items with too few
    raters are dropped first, which is exact.

    Pairs of few items are combined on the map side and moved as rows. Where most pairs occur once that
    would only move them all: each item of a user then goes with the list of the greater ones to the
    task that counts its pairs. The ratings are stored, as they are counted before they are paired.
    """
    if min_strength > 1:
        frequent = ratings.groupBy("item").agg(F.count(F.lit(1)).alias("raters"))
        frequent = frequent.where(F.col("raters") >= min_strength).select("item")
        ratings = ratings.join(frequent, "item", "left_semi")
    pairs = _pairs(keep(ratings.select("user", "item", "rating"), "paired-ratings"))
    return pairs.where(F.col("strength") >= min_strength) if min_strength > 1 else pairs


def _widths(ratings: DataFrame) -> list[tuple[int, int]]:
    """``(items, users)``, how many users rated so many items: rows like the root of the ratings at most."""
    width = ratings.where(F.col("user").isNotNull()).groupBy("user").agg(F.count(F.lit(1)).alias("items"))
    return [tuple(r) for r in width.groupBy("items").agg(F.count(F.lit(1)).alias("users")).collect()]


def _fits(column: str, kind: str):
    """Whether all values of a column, but nulls, are the same in a narrower type."""
    same = F.expr(f"try_cast({column} AS {kind}) = {column}")
    return F.coalesce(F.bool_and(F.coalesce(same, F.col(column).isNull())), F.lit(True)).alias(f"{column}_{kind}")


def _pairs(ratings: DataFrame) -> DataFrame:
    """``item_pairs`` of stored ratings."""
    tasks = int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    widths = _widths(ratings)
    rows = sum(n * w * (w - 1) // 2 for w, n in widths)
    types = dict(ratings.dtypes)
    tried = [("rating", k) for k in ("tinyint", "smallint", "float")]
    tried += [("item", "int")] if types["item"] == "bigint" else []
    raters = ratings.groupBy("item").agg(F.count(F.lit(1)).alias("raters"))
    known = raters.agg(F.count(F.lit(1)).alias("items"), F.max("raters").alias("most")).first()
    if known["items"] ** 2 / 2 * tasks <= rows / 2:
        return _summed(_unit_pairs(ratings, tasks), types)
    # As an item of an average list; at most a quarter of the tasks' number have more.
    much = 4 * TASK_PAIRS * sum(w * n for w, n in widths) / max(rows, 1)
    hot = [r["item"] for r in raters.where(F.col("raters") > much).collect()] if (known["most"] or 0) > much else []
    facts = ratings.agg(*(_fits(*x) for x in tried)).first()
    narrow = {c: next((k for c_, k in tried if c_ == c and facts[f"{c}_{k}"]), types[c]) for c in ("item", "rating")}
    ratings = ratings.select("user", *(F.col(c).cast(k).alias(c) for c, k in narrow.items()))
    tasks, widest = max(tasks, -(-rows // TASK_PAIRS)), max((w for w, _ in widths), default=0)
    return _summed(_listed_pairs(ratings, widest, tasks, hot), types, *(["dealt"] if hot else []))


def _summed(pairs: DataFrame, types: dict[str, str], *dealt: str) -> DataFrame:
    """Sums of ``pairs (item_x, item_y, x, y)``, with the types that the ratings had.

    ``dealt`` names what the pairs are dealt by besides ``item_x``, a function of both items.
    """
    a, b = (F.col(c).cast(types["rating"]) for c in "xy")
    summed = pairs.groupBy("item_x", *dealt, "item_y").agg(
        F.sum(a * a).alias("sum_xx"),
        F.sum(a * b).alias("sum_xy"),
        F.sum(b * b).alias("sum_yy"),
        F.count(F.lit(1)).alias("strength"),
    )
    item = [F.col(c).cast(types["item"]).alias(c) for c in ("item_x", "item_y")]
    return summed.select(*item, "sum_xx", "sum_xy", "sum_yy", "strength")


def _units(ratings: DataFrame, tasks: int) -> DataFrame:
    """``(user, left, right, block, item, rating)``: each item once in each unit of its user."""
    # Counting the rating, not the rows, keeps this branch's columns equal to the other's, so that
    # both read one shuffle of the ratings.
    blocks = (
        ratings.groupBy("user").agg(F.count("rating").alias("items"))
        .select("user", F.ceil(F.col("items") / UNIT_ITEMS).alias("blocks"))
    )
    block = F.pmod(F.xxhash64("item"), F.col("blocks"))
    # A fixed number of partitions: by their bytes AQE would merge them, but work is quadratic.
    return (
        ratings.join(blocks, "user")
        .select("user", "item", "rating", block.alias("block"), F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1).alias("peers"))
        .withColumn("peer", F.explode("peers"))
        .select(
            "user",
            F.least("block", "peer").alias("left"),
            F.greatest("block", "peer").alias("right"),
            "block",
            "item",
            "rating",
        )
        .repartition(tasks, "user", "left", "right")
    )


def _unit_pairs(ratings: DataFrame, tasks: int) -> DataFrame:
    """``(item_x, item_y, x, y)`` by a join of the units with themselves."""
    units = _units(ratings, tasks)
    x, y = units.alias("x"), units.alias("y")
    same_unit = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("user", "left", "right")]
    # A unit of two blocks pairs one with the other; the pairs inside a block have their own unit.
    met = (F.col("x.left") == F.col("x.right")) | (F.col("x.block") != F.col("y.block"))
    return x.join(y, [*same_unit, F.col("x.item") < F.col("y.item"), met]).select(
        F.col("x.item").alias("item_x"), F.col("y.item").alias("item_y"), F.col("x.rating").alias("x"), F.col("y.rating").alias("y")
    )


def _listed_pairs(ratings: DataFrame, widest: int, tasks: int, hot: list) -> DataFrame:
    """The same, dealt by ``item_x`` to so many tasks in lists, so that sums need no further shuffle.

    The pairs of ``hot`` items, if there are any, are dealt by both items, ``dealt`` being a hash of the
    other one.
    """
    if widest <= UNIT_ITEMS:
        units = ratings.where("user IS NOT NULL AND item IS NOT NULL").withColumn("block", F.lit(0).cast("bigint"))
        key, one = ["user"], F.lit(True)
    else:
        parts = int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        units = _units(ratings.where("item IS NOT NULL"), parts)
        key, one = ["user", "left", "right"], F.col("left") == F.col("right")
    lists = units.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("item", "block", "rating"))).alias("all"))
    rest = F.slice("all", F.col("pos") + 2, F.size("all") - F.col("pos") - 1)
    rows = lists.where(F.size("all") > 1).select(one.alias("one"), "all", F.posexplode("all").alias("pos", "of"))
    # A unit of two blocks pairs one with the other; the pairs inside a block have their own unit.
    rest = F.when(F.col("one"), rest).otherwise(F.filter(rest, lambda y: y["block"] != F.col("of.block")))
    rows = rows.select(F.col("of.item").alias("item_x"), F.col("of.rating").alias("x"), rest.alias("rest")).where(F.size("rest") > 0)
    by = ["item_x", "dealt"] if hot else ["item_x"]  # a constant would hide from the sums how rows are dealt
    if hot:
        common = F.col("item_x").isin(hot)
        apart = rows.where(common).select("item_x", "x", F.explode("rest").alias("y"))
        apart = apart.select("item_x", "x", F.array("y").alias("rest"), F.pmod(F.xxhash64("y.item"), F.lit(tasks)).alias("dealt"))
        rows = rows.where(~common).withColumn("dealt", F.lit(-1).cast("bigint")).union(apart)
    # Two lists of plain values are far smaller than one of rows.
    rows = rows.select(*by, "x", F.col("rest.item").alias("items"), F.col("rest.rating").alias("ratings"))
    rows = rows.repartition(tasks, *by)
    pairs = rows.select(*by, "x", "ratings", F.posexplode("items").alias("at", "item_y"))
    return pairs.select(*by, "item_y", "x", F.col("ratings")[F.col("at")].alias("y")).where("item_x < item_y")


def cosine(pairs: DataFrame, zero: float | None = 0.0) -> DataFrame:
    """``(item_x, item_y, score, strength)``; ``zero`` is the score where a norm is 0."""
    norm = F.sqrt("sum_xx") * F.sqrt("sum_yy")
    return pairs.select("item_x", "item_y", safe_ratio(F.col("sum_xy"), norm, zero).alias("score"), "strength")


def pair_candidates(ratings: DataFrame, min_score: float, min_strength: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(candidates, head, tail)``: what pairs above both thresholds have in common, but for a few users.

    A pair needs ``t = min_strength + 1`` common users. The ``t // 2`` users of an item who rated most
    items are its tail, the others its head. In the order of users by ratings, every common user
    beyond the end of the head that ends first is in that head's tail; so heads share at least
    ``k = t - t // 2`` users, and at most ``t // 2`` are still missing from the sums over heads. By
    Cauchy and Schwarz they cannot lift ``xy / p`` above ``(xy + g) / (p + g)``, where ``p`` is the
    product of the norms so far and ``g`` that of the largest norms that can be missing. Pairs that
    fail either bound are no candidates. What is quadratic in a user's items is left to heads, which
    the users with most items are hardly in. Where tails cannot take half of the pairs, as no user
    stands out, heads are all ratings and tails are empty; the sums are then whole.
    """
    t = min_strength + 1
    few = t // 2
    raters = ratings.groupBy("item").agg(F.count(F.lit(1)).alias("raters"), F.max(F.col("rating") * F.col("rating")).alias("peak"))
    raters = keep(raters.where(F.col("raters") >= t), "raters")
    rated = ratings.join(raters.select("item"), "item", "left_semi").select("user", "item", "rating")
    rated = keep(rated, "rated")
    widths = sorted(_widths(rated), reverse=True)
    # At best all that tails hold are whole users, those with most items.
    room, pairs_left = few * raters.count(), sum(n * w * (w - 1) // 2 for w, n in widths)
    half = pairs_left / 2
    for w, n in widths:
        taken = min(n, -(-room // w))
        room, pairs_left = room - taken * w, pairs_left - taken * (w * (w - 1) // 2)
        if room <= 0:
            break
    if pairs_left > half:
        met = _pairs(rated).where(F.col("strength") >= t)
        able = F.col("sum_xy") >= (min_score - 1e-9) * F.sqrt("sum_xx") * F.sqrt("sum_yy")
        items = rated.select("item", "user", "rating")
        return keep(met.where(able), "pair-candidates"), items, items.where(F.lit(False))
    width = rated.groupBy("user").agg(F.count(F.lit(1)).alias("width"))
    ranked = keep(rated.join(width, "user"), "ranked-ratings")
    tail = keep(top_k_per_group(ranked, ["item"], ["-width", "user"], few).select("item", "user", "rating"), "tails")
    head = keep(ranked.join(tail, ["item", "user"], "left_anti").select("item", "user", "rating"), "heads")
    shared = _pairs(head).where(F.col("strength") >= t - few)
    # One row for each item: the optimizer broadcasts it below its threshold.
    for side in ("x", "y"):
        peak = raters.select(F.col("item").alias(f"item_{side}"), F.col("peak").alias(f"peak_{side}"))
        shared = shared.join(peak, f"item_{side}")
    p = F.sqrt("sum_xx") * F.sqrt("sum_yy")
    g = F.sqrt("peak_x") * F.sqrt("peak_y") * few
    # Room for the rounding of the bound itself.
    able = F.col("sum_xy") + g >= (min_score - 1e-9) * (p + g)
    return keep(shared.where(able).drop("peak_x", "peak_y"), "pair-candidates"), head, tail


def similar_pairs(
    ratings: DataFrame, min_score: float = 0.97, min_strength: int = 50, zero: float | None = 0.0
) -> DataFrame:
    """The rows of ``cosine`` above both thresholds, without the table of all pairs.

    Candidates come with their sums over the heads of both items; a candidate then meets the tails,
    ``min_strength`` users of the two at most, and only what it has in common with them is added.
    """
    found, head, tail = pair_candidates(ratings, min_score, min_strength)
    names = ["item_x", "item_y"]
    pairs = found.select(*names)

    def met(one: str, other: str, theirs: DataFrame) -> DataFrame:
        """Common users in the tail of side ``one``, and in the given ratings of side ``other``."""
        mine = tail.select(F.col("item").alias(f"item_{one}"), "user", F.col("rating").alias(one))
        own = theirs.select(F.col("item").alias(f"item_{other}"), "user", F.col("rating").alias(other))
        return pairs.join(mine, f"item_{one}").join(own, [f"item_{other}", "user"]).select(*names, "x", "y")

    late = met("x", "y", head.union(tail)).union(met("y", "x", head))
    x, y = F.col("x"), F.col("y")
    late = late.select(
        *names, (x * x).alias("sum_xx"), (x * y).alias("sum_xy"), (y * y).alias("sum_yy"), F.lit(1).cast("bigint").alias("strength")
    )
    sums = [F.sum(c).alias(c) for c in ("sum_xx", "sum_xy", "sum_yy", "strength")]
    whole = found.union(late.select(*found.columns)).groupBy(*names).agg(*sums)
    scores = cosine(whole.where(F.col("strength") > min_strength), zero)
    return scores.where(F.col("score") > min_score)


def filter_similar(scores: DataFrame, item, min_score: float = 0.97, min_strength: int = 50) -> DataFrame:
    """Pairs of ``cosine`` that touch ``item`` and pass both thresholds, as ``(item, score, strength)``."""
    key = F.lit(item)
    x, y = F.col("item_x"), F.col("item_y")
    return scores.where(
        ((x == key) | (y == key)) & (F.col("score") > min_score) & (F.col("strength") > min_strength)
    ).select(other_side(x, y, key).alias("item"), "score", "strength")


def similarity_to(ratings: DataFrame, item, zero: float | None = 0.0) -> DataFrame:
    """Cosine of every other item with one item: the rows of ``cosine`` that touch it.

    Only that item's raters matter, so each rating meets at most one row of the item: the cost is
    linear in the ratings, where all pairs would be quadratic per user.
    """
    key = F.lit(item)
    mine = ratings.where(F.col("item") == key).select("user", F.col("rating").alias("rating_x"))
    pairs = (
        ratings.where(F.col("item") != key).withColumnRenamed("rating", "rating_y").join(mine, "user")
        .groupBy("item")
        .agg(
            F.sum(F.col("rating_x") * F.col("rating_x")).alias("sum_xx"),
            F.sum(F.col("rating_x") * F.col("rating_y")).alias("sum_xy"),
            F.sum(F.col("rating_y") * F.col("rating_y")).alias("sum_yy"),
            F.count(F.lit(1)).alias("strength"),
        )
    )
    norm = F.sqrt("sum_xx") * F.sqrt("sum_yy")
    return pairs.select("item", safe_ratio(F.col("sum_xy"), norm, zero).alias("score"), "strength")


def similar_items(
    ratings: DataFrame, item, min_score: float = 0.97, min_strength: int = 50, k: int = 10
) -> DataFrame:
    """The ``k`` items most similar to ``item``: best score, then strength, then item."""
    good = similarity_to(ratings, item).where(
        (F.col("score") > min_score) & (F.col("strength") > min_strength)
    )
    return top_k(good, ["-score", "-strength", "item"], k).withColumn("score", F.round("score", 3))
