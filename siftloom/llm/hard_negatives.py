"""Hard negatives for anchors, from lists that clusters of anchors share.

Anchors are clustered by direction. For a cluster with centroid c and largest member angle t, a row x at angle a from c
has an inner product of at most ``|u| |x| cos(max(0, a - t))`` with any member u. Rows, in blocks within tasks, are
sorted by that bound once per cluster, and every member walks the shared list until the bound certifies that no row
behind can enter its result. The walk serves both questions: the best rows of the anchor's own label, and for each of
these the best rows of other labels within a band of scores below it.

Anchors lie in files of bounded size in the shared folder, which tasks read one by one, so neither the driver nor a task
holds all of them. Each block of rows gives its own best few; windows over these few pick the overall ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftloom.llm.samples import below
from siftloom.llm.store import map_arrow, shared_folder, stored
from siftloom.llm.vectors import dimension, matrix, usable, whole
from siftloom.llm.warc import _files as files_of

#: Rows sorted at once, anchors in a file, anchors per cluster on average, and clusters at most.
BLOCK, PART, CLUSTER, CLUSTERS = 32_768, 1_024, 256, 256
#: Bounded samples: anchors that the centroids are fitted to, rows that give every anchor a first lower bound.
FIT_SAMPLE, BOUND_SAMPLE = 8_192, 4_096
ROUNDS = 10
FIRST_STEP, LAST_STEP = 256, 4_096
#: Rounding of angles (radians) and of inner products (relative), by which bounds are raised.
ANGLE_SLACK, SLACK = 1e-6, 1e-9
_LOW = -2.0 ** 1000


def centroids(x: np.ndarray, count: int, seed: int = 5) -> np.ndarray:
    """Spherical k-means: unit vectors in the directions of clusters of the rows of ``x``."""
    norm = np.linalg.norm(x, axis=1)
    unit = x[norm > 0] / norm[norm > 0, None]
    if not len(unit):
        return np.zeros((1, x.shape[1]))
    random = np.random.default_rng(seed)
    middle = unit[random.choice(len(unit), min(count, len(unit)), replace=False)]
    for _ in range(ROUNDS):
        mine = (unit @ middle.T).argmax(axis=1)
        total = np.zeros_like(middle)
        np.add.at(total, mine, unit)
        size = np.linalg.norm(total, axis=1)
        middle = np.where(size[:, None] > 0, total / np.maximum(size, 1e-300)[:, None], middle)
    return middle


def angles(x: np.ndarray, norm: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """Angles between the rows of ``x`` and each centroid; 0 for zero vectors."""
    cosine = x @ middle.T / np.where(norm > 0, norm, 1)[:, None]
    cosine[norm == 0] = 1
    return np.arccos(np.clip(cosine, -1, 1))


def walk(x: np.ndarray, ids: np.ndarray, labels: np.ndarray, order: np.ndarray, bounds: np.ndarray, members: dict[str, np.ndarray],
         same: bool, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Best ``k`` rows for each slot of each member: slot (member * slots + slot), row, score, and how many scores were taken.

    ``members`` has ``x``, ``id``, ``label`` and, per slot, ``cap`` and ``floor``: scores lie between them. ``same`` asks for
    other rows of the member's label, else rows of other labels count. Higher scores come first, then smaller ids.
    """
    u, cap = members["x"], members["cap"]
    slots = cap.shape[1]
    norm = np.linalg.norm(u, axis=1)
    best = np.where(members["floor"] <= cap, members["floor"], np.inf)
    last = np.full(best.shape, np.iinfo(np.int64).max)
    slot, row, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    active = np.flatnonzero(np.isfinite(best).any(axis=1))
    at, step, taken = 0, FIRST_STEP, 0
    while at < len(order):
        limit = bounds[order[at]] * norm[active]
        active = active[(best[active] <= (limit + SLACK * np.abs(limit) + SLACK)[:, None]).any(axis=1)]
        if not len(active):
            break
        turn = order[at:at + step]
        s = u[active] @ x[turn].T
        taken += s.size
        fits = (members["label"][active][:, None] == labels[turn]) == same
        if same:
            fits &= members["id"][active][:, None] != ids[turn]
        new = [(slot, row, score)]
        for j in range(slots):
            floor = best[active, j][:, None]
            hit = fits & (s <= cap[active, j][:, None]) & ((s > floor) | ((s == floor) & (ids[turn] < last[active, j][:, None])))
            a, b = np.nonzero(hit)
            new.append((active[a] * slots + j, turn[b], s[a, b]))
        slot, row, score = (np.concatenate(c) for c in zip(*new))
        by = np.lexsort((ids[row], -score, slot))
        slot, row, score = slot[by], row[by], score[by]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, np.int64)
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        slot, row, score, rank = (c[rank < k] for c in (slot, row, score, rank))
        full = rank == k - 1
        best[slot[full] // slots, slot[full] % slots] = score[full]
        last[slot[full] // slots, slot[full] % slots] = ids[row[full]]
        at += step
        step = min(step * 2, LAST_STEP)
    return slot, row, score, taken


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and vectors of up to ``BLOCK`` rows at once, fewer of very long vectors."""
    size, held, n = min(BLOCK, max(1, (BLOCK << 7) // max(d, 1))), [], 0

    def together():
        table = pa.Table.from_batches(held)
        return (table.column(0).to_numpy(), table.column(1).to_numpy(), matrix(table.column(2), d).astype(np.float64))

    for batch in batches:
        for a in range(0, batch.num_rows, size):
            part = batch.slice(a, size)
            if n + part.num_rows > size:
                yield together()
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if n:
        yield together()


def _search(rows: DataFrame, folder: str, shape: list[tuple[np.ndarray, float, int]], d: int, same: bool, k: int) -> DataFrame:
    """``cluster, part, pos, cap, id, score``: the best of every block of rows for every anchor in the files of ``folder``."""
    sent = rows.sparkSession.sparkContext.broadcast(shape)

    def members_of(cluster: int, part: int) -> dict[str, np.ndarray] | None:
        system, path = files_of(f"{folder}/cluster={cluster}/part={part}")
        found = system.get_file_info(pa.fs.FileSelector(path, allow_not_found=True))
        tables = [pa.parquet.read_table(f.path, filesystem=system, partitioning=None) for f in found if f.path.endswith(".parquet")]
        if not tables:  # the hash dealt no anchor to this part
            return None
        table = pa.concat_tables(tables)
        slots = max((len(c) for c in table.column("caps").to_pylist()), default=0)
        cap, floor = np.full((len(table), slots), -np.inf), np.full((len(table), slots), np.inf)
        for name, out in (("caps", cap), ("floors", floor)):
            for i, values in enumerate(table.column(name).to_pylist()):
                out[i, :len(values)] = values
        return {"x": matrix(table.column("x"), d).astype(np.float64), "id": table.column("id").to_numpy(), "label": table.column("label").to_numpy(),
                "pos": table.column("pos").to_numpy(), "cap": cap, "floor": floor}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, x in _blocks(batches, d):
            norm = np.linalg.norm(x, axis=1)
            for cluster, (middle, angle, parts) in enumerate(sent.value):
                if not parts:
                    continue
                away = angles(x, norm, middle[None])[:, 0]
                bounds = norm * np.cos(np.clip(away - angle - ANGLE_SLACK, 0, np.pi))
                order = np.argsort(-bounds, kind="stable")
                for part in range(parts):
                    if (members := members_of(cluster, part)) is None:
                        continue
                    slot, row, score, _ = walk(x, ids, labels, order, bounds, members, same, k)
                    slots = members["cap"].shape[1]
                    if len(slot):
                        member = slot // slots
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(slot), cluster, np.int32)), pa.array(np.full(len(slot), part, np.int32)),
                            pa.array(members["pos"][member].astype(np.int32)), pa.array(members["cap"][member, slot % slots]),
                            pa.array(ids[row]), pa.array(np.clip(score, -2.0 ** 62, 2.0 ** 62).astype(np.int64))],
                            ["cluster", "part", "pos", "cap", "id", "score"])

    return map_arrow(rows.select("id", "label", "x"), run, "cluster int, part int, pos int, cap double, id bigint, score bigint")


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _in_files(anchors: DataFrame, folder: str) -> str:
    anchors.repartition("cluster", "part").write.partitionBy("cluster", "part").parquet(folder)
    return folder


def mine(embeddings: DataFrame, is_anchor: Column, vector: str = "embedding", row_id: str = "vec_id", label: str = "label",
         positives: int = 5, negatives: int = 5, low: int = 80) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` (all whole numbers).

    The positives of an anchor (``is_anchor``, over the input's columns) are its best rows with its label and another id;
    for each come the best rows of other labels with ``low * positive_score <= 100 * score <= 100 * positive_score``.
    Scores are inner products of ``floor(256 * c)``, exact up to 2^53; higher ones come first, then smaller ids. Rows take
    no part if their id, label or vector is null, if the vector has null or non-finite entries, or if it has another
    length than most have (the longer of equally frequent ones). Repeated rows count each, as rows and as anchors. Without
    anchors, or without rows in the band, nothing comes.
    """
    spark = embeddings.sparkSession
    columns = [F.col(f"`{row_id}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("bigint").alias("label"), whole(vector).alias("x")]
    rows = stored(embeddings.where(usable(vector)).select(*columns, F.coalesce(is_anchor, F.lit(False)).alias("anchor")).where("id is not null and label is not null"))
    d = dimension(rows, "x")
    rows = rows.where(F.size("x") == d)
    result = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    total, count = rows.agg(F.count("*"), F.count_if("anchor")).first()
    if not count or not d:
        return spark.createDataFrame([], result)

    anchors = rows.where("anchor").select("id", "label", "x")
    hash_ = F.xxhash64("id", F.lit(11))
    fit = sorted((r["id"], r["x"]) for r in anchors.where(below(hash_, FIT_SAMPLE / count)).collect())
    middle = centroids(np.array([x for _, x in fit], np.float64).reshape(-1, d), min(CLUSTERS, -(-count // CLUSTER)))
    few = rows.where(below(hash_, BOUND_SAMPLE / total)).select("id", "label", "x").collect()
    sent = spark.sparkContext.broadcast((middle, np.array([r["x"] for r in few], np.float64).reshape(-1, d),
                                         np.array([r["id"] for r in few], np.int64), np.array([r["label"] for r in few], np.int64)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, sample, ids, labels = sent.value
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                x, own, kind = matrix(part.column(2), d).astype(np.float64), part.column(0).to_numpy(), part.column(1).to_numpy()
                away = angles(x, np.linalg.norm(x, axis=1), middle)
                floor = np.full(len(x), _LOW)
                if len(ids) >= positives:
                    s = np.where((kind[:, None] == labels) & (own[:, None] != ids), x @ sample.T, -np.inf)
                    floor = np.maximum(floor, np.partition(s, len(ids) - positives, axis=1)[:, len(ids) - positives])
                mine = away.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(mine.astype(np.int32)), pa.array(away[np.arange(len(x)), mine]), pa.array(floor)],
                                                 ["id", "label", "x", "cluster", "angle", "floor"])

    placed = stored(map_arrow(anchors, place, "id bigint, label bigint, x array<bigint>, cluster int, angle double, floor double"))
    sizes = {r["cluster"]: r for r in placed.groupBy("cluster").agg(F.count("*").alias("n"), F.max("angle").alias("angle")).collect()}
    shape = [(middle[i], sizes[i]["angle"] if i in sizes else 0.0, -(-sizes[i]["n"] // PART) if i in sizes else 0) for i in range(len(middle))]
    parts = F.element_at(F.array(*[F.lit(max(1, p)) for _, _, p in shape]), F.col("cluster") + 1)
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    pos = F.row_number().over(Window.partitionBy("cluster", "part").orderBy("id", "label", "x"))
    dealt = stored(dealt.withColumn("pos", pos))

    key = ["cluster", "part", "pos"]
    first = _in_files(dealt.select("*", F.array(F.lit(float("inf"))).alias("caps"), F.array("floor").alias("floors")).drop("floor", "angle"), shared_folder(spark))
    near = stored(_best(_search(rows, first, shape, d, True, positives), key, positives).select(*key, "id", "score"))

    cap = near.where("score >= 0").select(*key, F.col("score").cast("double").alias("cap")).distinct() \
        .groupBy(*key).agg(F.sort_array(F.collect_list("cap")).alias("caps"))
    banded = dealt.join(cap, key, "left").withColumn("caps", F.coalesce("caps", F.array().cast("array<double>"))).drop("floor", "angle")
    floors = F.transform("caps", lambda c: F.ceil(c * low / 100).cast("double"))
    second = _in_files(banded.withColumn("floors", floors), shared_folder(spark))
    far = _best(_search(rows, second, shape, d, False, negatives), [*key, "cap"], negatives)
    pairs = near.join(dealt.select(*key, F.col("id").alias("anchor_id")), key).select(
        *key, "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.col("score").cast("double").alias("cap"))
    return pairs.join(far, [*key, "cap"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                                                 "positive_score", F.col("score").alias("negative_score"))
