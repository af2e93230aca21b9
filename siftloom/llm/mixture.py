"""Mixing sources to target weights over a tree domain > language > source.

A token budget goes down the tree by weight. A child gets no more than its subtree can give (its tokens times the
epochs allowed); what it cannot use goes to its siblings, and only what they cannot use goes to the parent's siblings.
Each leaf then gives whole epochs and a prefix of one more, in an order seeded by epoch. The prefix is found by sums
over digits of the order key, so no leaf is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftloom.llm.store import small_side, stored

LEVELS = ("domain", "lang", "source")
#: Hex digits of the order key taken at once, and how often, before the rest is ranked one by one.
DIGITS, ROUNDS = 3, 2
WORD = r"[^\x20\x09-\x0D]+"


def _map(values: dict[str, float], key: Column) -> Column:
    if not values:
        return F.lit(1.0)
    return F.coalesce(F.create_map(*[F.lit(x) for k, v in sorted(values.items()) for x in (k, float(v))])[key], F.lit(1.0))


def fill(children: DataFrame, parent: list[str], budget: str, weight: str, capacity: str, out: str) -> DataFrame:
    """Share each parent's budget among its children by weight, none above its capacity.

    With children in the order of capacity / weight, the level of the last ones that are not full is the largest
    (budget - capacities before) / (weights from here on).
    """
    order = [F.col(capacity) / F.col(weight), *[F.col(c) for c in LEVELS if c in children.columns]]
    siblings = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    before = siblings.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = siblings.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    level = (F.col(budget) - F.coalesce(F.sum(capacity).over(before), F.lit(0.0))) / F.sum(weight).over(after)
    return children.withColumn("level", level) \
        .withColumn(out, F.greatest(F.lit(0.0), F.least(F.col(capacity), F.max("level").over(siblings) * F.col(weight)))).drop("level")


def quotas(leaves: DataFrame, budget: Column | int, weights: dict[str, dict[str, float]], epochs: float) -> DataFrame:
    """Leaves (``domain``, ``lang``, ``source``, ``tokens``) with ``quota``: whole tokens of the budget."""
    rows = leaves.withColumn("total", F.sum("tokens").over(Window.partitionBy(F.lit(0)))) if isinstance(budget, Column) else leaves
    for level in LEVELS:
        w = _map(weights.get(level, {}), F.coalesce(level, F.lit("")))
        rows = rows.withColumn(f"{level}_weight", w)
    none = F.least(*[F.col(f"{level}_weight") for level in LEVELS]) <= 0
    rows = rows.withColumn("source_cap", F.when(none, 0.0).otherwise(F.col("tokens") * F.lit(float(epochs))))
    # A part without weight has no capacity, and any weight will do.
    rows = rows.select("*", *[F.when(F.col(f"{level}_weight") <= 0, 1.0).otherwise(F.col(f"{level}_weight")).alias(f"{level}_w") for level in LEVELS])
    total = budget if isinstance(budget, Column) else F.lit(budget)
    langs = rows.groupBy("domain", "lang", "domain_w", "lang_w").agg(F.sum("source_cap").alias("lang_cap"), F.max(total).alias("total"))
    domains = langs.groupBy("domain", "domain_w").agg(F.sum("lang_cap").alias("domain_cap"), F.max("total").cast("double").alias("total"))
    domains = fill(domains, [], "total", "domain_w", "domain_cap", "domain_share").select("domain", "domain_share")
    langs = langs.join(domains, langs["domain"].eqNullSafe(domains["domain"])).select(langs["*"], "domain_share")
    langs = fill(langs, ["domain"], "domain_share", "lang_w", "lang_cap", "lang_share").select("domain", "lang", "lang_share")
    rows = rows.join(langs, rows["domain"].eqNullSafe(langs["domain"]) & rows["lang"].eqNullSafe(langs["lang"])).select(rows["*"], "lang_share")
    rows = fill(rows, ["domain", "lang"], "lang_share", "source_w", "source_cap", "share")
    return rows.select(*LEVELS, "tokens", F.floor(F.col("share") + F.lit(1e-6)).cast("bigint").alias("quota"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    out = F.lit(True)
    for level in LEVELS:
        out = out & a[level].eqNullSafe(b[level])
    return out


def _cut(keys: DataFrame, leaves: DataFrame) -> DataFrame:
    """The largest order key of each leaf's prefix: its tokens up to there are ``rest`` or fewer."""
    side = small_side(leaves)
    rows = keys.join(side, _same(keys, side)).select(*[keys[c] for c in LEVELS], "tokens", "rest", F.expr("left(key, 0)").alias("done"),
                                                      F.col("key").alias("key"))
    bounds = []
    for _ in range(ROUNDS):
        digits = F.concat("done", F.substring(F.col("key"), F.length("done") + 1, F.lit(DIGITS)))
        sums = rows.groupBy(*LEVELS, digits.alias("part")).agg(F.sum("tokens").alias("tokens"), F.max("rest").alias("rest"), F.max("key").alias("top"))
        order = Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("upto", F.sum("tokens").over(order))
        bounds.append(sums.where("upto <= rest").groupBy(*LEVELS).agg(F.max("top").alias("key")))
        # The first part that goes beyond: the prefix ends in it.
        ends = sums.where("upto > rest and upto - tokens <= rest").groupBy(*LEVELS).agg(
            F.min_by(F.struct("part", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("rest")), "part").alias("end"))
        ends = stored(ends.select(*LEVELS, "end.part", F.col("end.rest").alias("left_over")))
        side = small_side(ends)
        rows = rows.join(side, _same(rows, side) & F.col("key").startswith(F.col("part"))) \
            .select(*[rows[c] for c in LEVELS], "tokens", F.col("left_over").alias("rest"), F.col("part").alias("done"), "key")
    order = Window.partitionBy(*LEVELS).orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    last = rows.withColumn("upto", F.sum("tokens").over(order)).where("upto <= rest").groupBy(*LEVELS).agg(F.max("key").alias("key"))
    for b in bounds:
        last = last.unionByName(b)
    return last.groupBy(*LEVELS).agg(F.max("key").alias("cut"))


def _text_key(seed: int, epoch: Column, doc_id: str, digest: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(digest), F.lit(""))))


def mix(documents: DataFrame, domain: Column, budget: int | None = None, share: float = 1.0, epochs: int = 2,
        weights: dict[str, dict[str, float]] | None = None, seed: int = 0) -> DataFrame:
    """Documents chosen for the mixture: ``doc`` (the input row), ``epoch`` (from 0), ``tokens``.

    ``budget`` is in tokens (blank-separated words); without it, ``share`` of all tokens. ``weights`` gives weights by
    level (``domain``, ``lang``, ``source``) and name; names not listed weigh 1, those with 0 or less get nothing. A
    null name is a name of its own (listed as ""). ``epochs`` is how often a leaf may be repeated. In each epoch the
    documents of a leaf come in the order of MD5(seed:epoch:doc_id:MD5(text)); the last epoch ends before the first
    document that would exceed the quota. Rows with equal id and text go together or not at all. Null and empty texts
    have no tokens and come along where their place is within the prefix. An empty table gives no rows.
    """
    keyed = documents.select(domain.cast("string").alias("domain"), F.col("lang").cast("string").alias("lang"),
                             F.col("source").cast("string").alias("source"), "doc_id", F.md5("text").alias("digest"),
                             F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("tokens"))
    keyed = stored(keyed)
    leaves = keyed.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    total = F.lit(budget) if budget is not None else F.floor(F.col("total") * F.lit(share))
    shares = quotas(leaves, total if budget is None else budget, weights or {}, epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.greatest("tokens", F.lit(1)))).otherwise(0).cast("int")
    shares = stored(shares.withColumn("whole", whole).withColumn("rest", F.col("quota") - F.col("whole") * F.col("tokens"))
                    .select(*LEVELS, "whole", "rest"))
    side = small_side(shares)
    keys = keyed.join(side, _same(keyed, side)).where("rest > 0").select(
        *[keyed[c] for c in LEVELS], "tokens", _text_key(seed, F.col("whole"), "doc_id", "digest").alias("key"))
    cuts = _cut(keys, shares.where("rest > 0").select(*LEVELS, "rest"))
    plan = stored(shares.join(cuts, _same(shares, cuts), "left").select(*[shares[c] for c in LEVELS], "whole", "cut"))
    side = small_side(plan)
    docs = documents.select(F.struct("*").alias("doc"), domain.cast("string").alias("domain"), F.col("lang").cast("string").alias("lang"),
                            F.col("source").cast("string").alias("source"), F.col("doc_id").alias("id"), F.md5("text").alias("digest"),
                            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("tokens"))
    joined = docs.join(side, _same(docs, side)).select("doc", "tokens", "whole", "cut", _text_key(seed, F.col("whole"), "id", "digest").alias("key"))
    copies = F.col("whole") + F.coalesce((F.col("key") <= F.col("cut")).cast("int"), F.lit(0))
    return joined.withColumn("copies", copies).where("copies > 0") \
        .select("doc", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"), "tokens")
