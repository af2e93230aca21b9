"""Building blocks that stay safe when one key holds a large share of all rows.

Everything else in the package that groups, ranks or matches rows goes through
these functions. None of them sends an unbounded group to one task: groups are
pre-aggregated before the shuffle, hot keys are spread, and ranks are taken in
two steps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.text import free_name, named, row_digest
from ..sources.identity import pin

# A hot-key list has at most this many rows, so it can always be broadcast.
HOT_KEYS = 1_000

# Slices per group for the first step of a two-step ranking.
RANK_SLICES = 64

# Slices of row ids when the first ones of a selection are looked up.
ID_SLICES = 512

# Row ids per block (2 to this power) when the first rows of a large selection are looked up.
ID_BLOCK_BITS = 17

# Largest n for which a plain top-n may go through one task.
PLAIN_TOP_N = 1_000

# Largest list of row ids that is broadcast (8 bytes each).
BROADCAST_IDS = 1_000_000

# Bits (2 to this power) of the bitmap that stands for a larger list: 32 MB whatever the table, in pieces of 4 KB.
BITMAP_BITS = 28

_LOG2_SPAN = 1_075.0
_COARSE = float(1 << 8)

# Equal steps that a bucket is cut into, and how often.
LINEAR, LINEAR_STEPS = 65_536, 2


def row_identity(df: DataFrame, columns: list[str]) -> list[Column]:
    """Grouping columns that are equal exactly for equal rows.

    Numbers and times stand for themselves, everything else goes into one digest; both take -0.0 as 0.0 and all NaN
    as one value.
    """
    fixed = [c for c in columns if isinstance(df.schema[c].dataType, (T.NumericType, T.DatetimeType, T.BooleanType))]
    rest = [c for c in columns if c not in fixed]
    digest = [row_digest(df, rest).alias("__digest")] if rest else []
    return [named(c).alias(f"__id_{i}") for i, c in enumerate(fixed)] + digest


def first_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """For every key the whole row with the smallest ``order``.

    An aggregate, not a window: each task first reduces its own rows to one per
    key, so a key that holds a third of the table is still cheap.
    """
    return _pick_per_key(df, keys, F.min_by, order)


def last_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """For every key the whole row with the largest ``order``."""
    return _pick_per_key(df, keys, F.max_by, order)


def _pick_per_key(df: DataFrame, keys: list[str], pick, order: Column) -> DataFrame:
    row = F.struct(*[named(c) for c in df.columns])
    return df.groupBy(*[named(k).alias(f"__key_{i}") for i, k in enumerate(keys)]).agg(
        pick(row, order).alias("__row")).select("__row.*")


def _in_bitmap(bitmap: Column, position: Column) -> Column:
    """Whether a bit is set in a bitmap that ``bitmap_construct_agg`` made."""
    byte = F.substr(bitmap, F.shiftright(position, 3).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), position % 8) == 1


def rows_that_may_repeat(df: DataFrame, key: Column) -> DataFrame:
    """The rows whose ``key`` may occur more than once; where repeats are rare, next to no others.

    Only a 64-bit hash of each key is shuffled, and pre-aggregated before. The hashes that occur twice or more go to the
    rows: as a list where they are counted to be few, else as a bitmap of fixed size. So no row moves here.
    """
    hash_ = F.xxhash64(key)
    twice = pin(df.select(hash_.alias("h")).groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("h"))
    name = free_name(df.columns, "__h")
    hashed = df.withColumn(name, hash_)
    if twice.count() <= BROADCAST_IDS:
        return hashed.join(F.broadcast(twice), F.col(name) == F.col("h"), "left_semi").drop(name)
    place = F.pmod("h", F.lit(1 << BITMAP_BITS))
    bits = twice.select(F.bitmap_bucket_number(place).alias("__bucket"), F.bitmap_bit_position(place).alias("p")).groupBy("__bucket").agg(
        F.bitmap_construct_agg("p").alias("__bits"))
    mine = F.pmod(F.col(name), F.lit(1 << BITMAP_BITS))
    met = hashed.join(F.broadcast(bits), F.bitmap_bucket_number(mine) == F.col("__bucket"))
    return met.where(_in_bitmap(F.col("__bits"), F.bitmap_bit_position(mine))).drop(name, "__bucket", "__bits")


def rows_with_listed_key(df: DataFrame, listed: DataFrame, key: str, weight: str, row_id: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``listed`` (one row per key, with its row count)."""
    flag = free_name(df.columns, "__listed")
    return mark_listed(df, listed, key, weight, row_id, flag).where(F.col(flag)).drop(flag)


def mark_listed(df: DataFrame, listed: DataFrame, key: str, weight: str, row_id: str, flag: str) -> DataFrame:
    """Add ``flag``: whether ``key`` occurs in ``listed``.

    The ``HOT_KEYS`` heaviest keys are broadcast, a list whose size is bounded by
    construction. Their rows are decided on the spot; in the join with the full
    list they get a key of their own so that they spread over all tasks. No other
    key can hold more than one thousandth of the rows.
    """
    is_hot, hot_key, meets, is_cold = (free_name(df.columns, n) for n in ("__hot", "__hot_key", "__meet", "__cold"))
    hot = listed.orderBy(F.desc(weight)).limit(HOT_KEYS).select(F.col(key).alias(hot_key), F.lit(True).alias(is_hot))
    marked = df.join(F.broadcast(hot), df[key] == F.col(hot_key), "left").drop(hot_key)

    def meeting_key(table: DataFrame, without: Column) -> Column:
        # Never NULL, or Spark would push a null test, and with it the key's whole expression, into the scan.
        text = F.hex(key) if dict(table.dtypes)[key] == "binary" else F.col(key).cast("string")
        return F.when(F.col(key).isNull(), without).otherwise(F.concat(F.lit("key:"), F.coalesce(text, F.lit(""))))

    spread = F.concat(F.lit("row:"), F.coalesce(F.col(row_id).cast("string"), F.lit("")))
    marked = marked.withColumn(meets, F.when(F.col(is_hot), spread).otherwise(meeting_key(df, spread)))
    meet = listed.select(meeting_key(listed, F.lit("none")).alias(meets), F.lit(True).alias(is_cold))
    found = F.coalesce(F.col(is_hot) | F.col(is_cold), F.lit(False))
    return marked.join(meet, meets, "left").select(*[named(c) for c in df.columns], found.alias(flag))


def first_rows(df: DataFrame, n: int, row_id: str) -> DataFrame:
    """The ``n`` rows with the smallest row ids.

    A plain top-n merges up to ``n`` rows of every task in one place. For a large
    ``n`` only blocks of ids that can hold one of the first ``n`` rows are kept,
    which bounds the merge to ``n`` rows plus one block; the condition is a plain
    comparison, so the file reader can skip everything behind it.
    """
    if n > PLAIN_TOP_N:
        block = F.shiftright(F.col(row_id).cast("long"), ID_BLOCK_BITS)
        blocks = df.groupBy(block.alias("block")).agg(F.count("*").alias("n"))
        running = blocks.select("block", F.sum("n").over(Window.orderBy("block")).alias("upto"))
        last = running.where(F.col("upto") >= n).agg(
            (F.shiftleft(F.min("block") + 1, ID_BLOCK_BITS) - 1).alias("last"))
        df = df.where(F.col(row_id) <= F.coalesce(last.scalar(), F.lit((1 << 63) - 1)))
    return df.orderBy(row_id).limit(n)


def first_selected_rows(df: DataFrame, selected: DataFrame, n: int, row_id: str) -> DataFrame:
    """The first ``n`` rows of ``df`` whose ids are in ``selected``.

    For selections that need a shuffle: only ids travel. Slices of ids keep their
    own first ``n``, one task merges those, and the at most ``n`` ids go back to
    the table, by broadcast as long as ``n`` is small. The table is read no
    further than the largest of them.
    """
    ids = selected.select(row_id)
    if n > PLAIN_TOP_N:
        slice_of = F.pmod(F.xxhash64(row_id), F.lit(ID_SLICES))
        rank = F.row_number().over(Window.partitionBy("__slice").orderBy(row_id))
        ids = (ids.withColumn("__slice", slice_of).withColumn("__rank", rank).where(F.col("__rank") <= n)
               .select(row_id))
    ids = ids.orderBy(row_id).limit(n)
    last = ids.agg(F.max(row_id)).scalar()
    if n <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.where(F.col(row_id) <= last).join(ids, row_id, "left_semi").orderBy(row_id)


def top_n_per_group(df: DataFrame, group: str, order: list[Column], n: int, slice_by: str) -> DataFrame:
    """The first ``n`` rows of every group, ranked in two steps.

    Each group is cut into slices by a hash of ``slice_by`` and every slice keeps
    its own first ``n`` rows; the final ranking then sees at most
    ``RANK_SLICES * n`` rows of a group, however large the group is.
    """
    columns = df.columns
    sliced = df.withColumn("__slice", F.pmod(F.xxhash64(slice_by), F.lit(RANK_SLICES)))
    inner = Window.partitionBy(group, "__slice").orderBy(*order)
    outer = Window.partitionBy(group).orderBy(*order)
    return (sliced.withColumn("__rank", F.row_number().over(inner)).where(F.col("__rank") <= n)
            .withColumn("__rank", F.row_number().over(outer)).where(F.col("__rank") <= n)
            .select(*columns))


def long_form(df: DataFrame, columns: list[str], values: list[Column], keep: list[str] | None = None,
              value: str = "value") -> DataFrame:
    """One row per (row, column): ``keep..., variable, <value>``; the values share one type."""
    keep = keep or []
    wide = df.select(*[named(k) for k in keep], *[v.alias(c) for c, v in zip(columns, values)])
    return wide.unpivot([named(k) for k in keep], [named(c) for c in columns], "variable", value)


def wide_to_rows(df: DataFrame, rows: list[list[Column]], names: list[str]) -> DataFrame:
    """Turn a one-row aggregate into a table, one struct per output row."""
    structs = [F.struct(*[c.alias(name) for c, name in zip(row, names)]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def sum_all(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _position(v: Column) -> Column:
    """A number that never falls when ``v`` rises, evenly spread over orders of magnitude.

    ``sign(v) * (log2|v| + 1075)`` covers every finite double. Only its
    monotony matters for exact ranks, its rounding does not.
    """
    return F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * (F.log2(F.abs(v)) + F.lit(_LOG2_SPAN)))


def exact_quantiles(long_df: DataFrame, group: str, value: str, probs: list[float]) -> DataFrame:
    """Exact quantiles per group with linear interpolation: ``group, q0, q1, ...``."""
    return quantiles_and_stats(long_df, group, value, probs).select(group, *[f"q{i}" for i in range(len(probs))])


def quantiles_and_stats(long_df: DataFrame, group: str, value: str, probs: list[float], stats: dict[str, tuple[Column, Column]] | None = None,
                        few_groups: bool = False) -> DataFrame:
    """Exact quantiles per group, and other aggregates taken on the same first pass.

    Spark's ``percentile`` keeps every distinct value of a group in one task.
    Here ranks are found by successive refinement instead: count rows per coarse
    value bucket, pick the bucket that holds each wanted rank, and count again
    in ``LINEAR`` equal steps between the smallest and the largest value of that
    bucket. A coarse bucket spans less than a half per cent of its values, so after two
    such steps it can hold a few thousand doubles at most, and these are listed.
    Each step is an aggregate with a bounded number of groups, so neither the
    number of rows nor one hot value matters, nor how close values lie. Steps
    that are not needed find an empty list of buckets and are dropped by adaptive
    execution.

    ``stats`` names pairs: an aggregate over the rows of a bucket, whose value is ``v``, NULL where
    there is none (such rows share one bucket), and one over the buckets' results,
    which are columns of that name. The lists of buckets have two rows per
    probability and group. Where the number of groups is bounded, as by a schema
    (``few_groups``), they are broadcast, so that no value is shuffled; else Spark
    decides from their size how to join them.
    """
    stats = stats or {}
    number = F.when(~F.isnan(value), F.col(value))
    rows = long_df.select(F.col(group).alias("g"), number.alias("v"), F.floor(_position(number) * _COARSE).alias("b1"))
    first = rows.groupBy("g", "b1").agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"),
                                        *[inner.alias(name) for name, (inner, _) in stats.items()])
    data = rows.where(F.col("v").isNotNull()).select("g", "v", "b1")
    keys = ["g", "q", "full_rank"]
    sent = F.broadcast if few_groups else (lambda df: df)

    def locate(counts: DataFrame, by: list[str], bucket: str) -> DataFrame:
        """Per wanted rank the bucket that holds it and the rank inside that bucket."""
        upto = F.sum("n").over(Window.partitionBy(*by).orderBy(bucket))
        running = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
        hit = running.where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("upto")))
        return hit.withColumn("rank", F.col("rank") - F.col("before"))

    known = first.where("n > 0").withColumn("total", F.sum("n").over(Window.partitionBy("g")))
    wanted = F.array_distinct(F.array(*[
        F.struct(F.lit(i).alias("q"), side.cast("long").alias("rank"))
        for i, p in enumerate(probs) for side in _neighbours(F.col("total"), p)]))
    upto = known.withColumn("upto", F.sum("n").over(Window.partitionBy("g").orderBy("b1")))
    ranks = upto.withColumn("before", F.col("upto") - F.col("n")).select("*", F.inline(wanted)).withColumn("full_rank", F.col("rank"))
    level = ranks.where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("upto"))) \
        .select(*keys, (F.col("rank") - F.col("before")).alias("rank"), "total", "b1", "low", "high")
    done = []
    for _ in range(LINEAR_STEPS):
        done.append(level.where("low = high").select(*keys, F.col("low").alias("v"), "total"))
        level = level.where("low < high")
        inside = data.join(sent(level), ["g", "b1"]).where((F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high")))
        share = (F.col("v") - F.col("low")) / (F.col("high") - F.col("low"))
        step = F.least(F.floor(share * LINEAR), F.lit(LINEAR - 1)).alias("b2")
        counts = inside.groupBy(*keys, "b1", step).agg(F.count("*").alias("n"), F.first("rank").alias("rank"), F.first("total").alias("total"),
                                                       F.min("v").alias("low"), F.max("v").alias("high"))
        level = locate(counts, keys, "b2").select(*keys, "rank", "total", "b1", "low", "high")
    done.append(level.where("low = high").select(*keys, F.col("low").alias("v"), "total"))
    level = level.where("low < high")
    inside = data.join(sent(level), ["g", "b1"]).where((F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high")))
    counts = inside.groupBy(*keys, "v").agg(F.count("*").alias("n"), F.first("rank").alias("rank"), F.first("total").alias("total"))
    picked = reduce(DataFrame.unionByName, done, locate(counts, keys, "v").select(*keys, "v", "total"))

    columns = []
    for i, p in enumerate(probs):
        mine = F.col("q") == i
        at = F.max(F.when(mine, F.col("total"))) - 1
        weight = at.cast("double") * F.lit(p)
        weight = weight - F.floor(weight)
        lo = F.min_by(F.when(mine, F.col("v")), F.when(mine, F.col("full_rank")))
        hi = F.max_by(F.when(mine, F.col("v")), F.when(mine, F.col("full_rank")))
        columns.append((lo + weight * (hi - lo)).alias(f"q{i}"))
    found = picked.groupBy("g").agg(*columns)
    if stats:
        sums = first.groupBy("g").agg(*[outer.alias(name) for name, (_, outer) in stats.items()])
        found = found.join(sums.withColumnRenamed("g", "__g"), F.col("g").eqNullSafe(F.col("__g"))).drop("__g")
    return found.withColumnRenamed("g", group)


def _neighbours(total: Column, p: float) -> list[Column]:
    """The two ranks (from 0) around probability ``p`` among ``total`` values."""
    at = (total - 1).cast("double") * F.lit(p)
    return [F.floor(at), F.ceil(at)]
