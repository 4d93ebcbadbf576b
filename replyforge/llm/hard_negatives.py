"""Hard-negative mining by exact inner products, with segment summaries in front of them.

``store`` writes the vectors in blocks: whole-number components, and of each segment of a vector its mean and deviation.
For two vectors a segment's part of the inner product lies between ``d * (m1 * m2 - s1 * s2)`` and
``d * (m1 * m2 + s1 * s2)``, with ``d`` components, means ``m`` and deviations ``s``. Summaries of longer segments follow
from those of the stored ones, so bounds start with the whole vector as one segment and are refined, level by level,
for the pairs that may still count; only what the finest level leaves is multiplied out.

``mine`` takes the anchors in blocks of bounded size (a stated part of the rows) against all rows. One pass finds each
anchor's positives, the best rows of its label; a second finds, for every positive, the best rows of other labels whose
score lies in its window. A pass is narrow: a task keeps the best rows per anchor it has seen, whose last score is the
next rows' bound, and gives them out at its end; the best of all tasks follow from a ranking by anchor.

A component ``x`` becomes ``floor(scale * x)``, a score is the whole-number inner product. Higher scores come first,
equal ones by smaller key; null keys last, then in the order of the rows as written. Rows with a null label, a null
vector, or a null or non-finite component take no part, nor do vectors without components or so long that scores would
not fit a long (sum of squares of ``2 ** 62`` or more). Rows that repeat a key are rows of their own, as anchors, too, and
may be each other's positives. Vectors of different sizes are not compared. Labels and keys have to be whole numbers.
Anchors without positives, and positives without rows in their window, give no row. Columns other than those named are
not read. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyforge.shipping import broadcast, opened
from replyforge.sources.storage import materialize

#: Segments of a vector from the coarsest to the stored level; fewer where it has fewer components.
LEVELS = (1, 4, 16)
#: Vectors of a block, and anchors compared with them at a time.
ROWS = 4096
TILE = 256
#: Bytes of the anchors that go to all tasks at a time.
ANCHOR_BYTES = 32 << 20
NULL_KEY = (1 << 63) - 1
#: Share of a tile's pairs from which on pairs are multiplied out as a matrix.
DENSE = 0.02

BLOCKS = "n int, dim int, width int, uids binary, keys binary, labels binary, anchors binary, vectors binary, means binary, deviations binary"


def segments(dim: int, level: int) -> np.ndarray:
    """Where the segments of a level start; each level's borders are among those of the next."""
    finest = min(dim, LEVELS[-1])
    starts = np.arange(finest) * dim // finest
    return starts[np.arange(min(level, finest)) * finest // min(level, finest)]


def summary(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment of the finest level."""
    starts = segments(vectors.shape[1], LEVELS[-1])
    sizes = np.diff(np.append(starts, vectors.shape[1]))
    means = np.add.reduceat(vectors, starts, axis=1) / sizes
    squares = np.add.reduceat((vectors - np.repeat(means, sizes, axis=1)) ** 2, starts, axis=1) / sizes
    return means, np.sqrt(squares)


def levels(means: np.ndarray, deviations: np.ndarray, dim: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level means and deviations times the root of the segments' sizes, so that bounds are plain products."""
    finest = segments(dim, LEVELS[-1])
    sizes = np.diff(np.append(finest, dim)).astype(float)
    found = []
    for level in LEVELS:
        starts = segments(dim, level)
        groups = np.searchsorted(finest, starts)
        total = np.add.reduceat(sizes, groups)
        mean = np.add.reduceat(means * sizes, groups, axis=1) / total
        square = np.add.reduceat((means**2 + deviations**2) * sizes, groups, axis=1) / total
        found.append((mean * np.sqrt(total), np.sqrt(np.maximum(square - mean**2, 0) * total)))
        if len(starts) == len(finest):
            break
    return found


class Vectors:
    """Vectors of one size with their numbers and bounds."""

    def __init__(self, dim: int, uids, keys, labels, vectors, means, deviations):
        self.dim, self.uids, self.keys, self.labels = dim, uids, keys, labels
        norms = np.sqrt(np.sum(vectors.astype(float) ** 2, axis=1))
        self.norms = norms
        # Sums of products below 2 ** 53 are exact in doubles, in any order.
        self.small = len(norms) == 0 or norms.max() < 1 << 26
        self.exact = vectors.astype(np.int64)
        self.fast = vectors.astype(float) if self.small else None
        self.levels = levels(means, deviations, dim)

    def pick(self, places: np.ndarray) -> Vectors:
        new = object.__new__(Vectors)
        new.dim, new.small = self.dim, self.small
        for name in ("uids", "keys", "labels", "norms", "exact", "fast"):
            value = getattr(self, name)
            setattr(new, name, None if value is None else value[places])
        new.levels = [(m[places], s[places]) for m, s in self.levels]
        return new


def bounds(anchors: Vectors, rows: Vectors, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of every pair at a level."""
    (am, asd), (rm, rsd) = anchors.levels[level], rows.levels[level]
    middle, spread = am @ rm.T, asd @ rsd.T
    spread += 1 + 1e-9 * np.outer(anchors.norms, rows.norms)  # rounding
    return middle - spread, middle + spread


def scores_of(anchors: Vectors, rows: Vectors, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Exact scores of pairs: as a matrix where many are asked for, else one by one."""
    a, r = pairs
    if len(a) > DENSE * len(anchors.uids) * len(rows.uids):
        if anchors.small and rows.small:
            return (anchors.fast @ rows.fast.T)[a, r].astype(np.int64)
        return (anchors.exact @ rows.exact.T)[a, r]
    found = np.empty(len(a), np.int64)
    for low in range(0, len(a), 1 << 16):
        part = slice(low, low + (1 << 16))
        found[part] = np.einsum("ij,ij->i", anchors.exact[a[part]], rows.exact[r[part]])
    return found


def filtered(anchors: Vectors, rows: Vectors, open_: np.ndarray, least: np.ndarray, most: np.ndarray | None):
    """Pairs of ``open_`` whose exact score lies from ``least`` to ``most`` (per anchor), with their scores.

    After each level the rows and anchors without a pair left are taken out.
    """
    a, r = np.arange(len(anchors.uids)), np.arange(len(rows.uids))
    for level in range(len(anchors.levels)):
        low, high = bounds(anchors, rows, level)
        open_ = open_ & (high >= least[a][:, None])
        if most is not None:
            open_ &= low <= most[a][:, None]
        keep_a, keep_r = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
        if not len(keep_a):
            break
        if len(keep_a) < len(a) or len(keep_r) < len(r):
            open_ = open_[np.ix_(keep_a, keep_r)]
            anchors, rows, a, r = anchors.pick(keep_a), rows.pick(keep_r), a[keep_a], r[keep_r]
    pairs = np.nonzero(open_)
    scores = scores_of(anchors, rows, pairs)
    pa_, pr = a[pairs[0]], r[pairs[1]]
    keep = scores >= least[pa_]
    if most is not None:
        keep &= scores <= most[pa_]
    return pa_[keep], pr[keep], scores[keep]


class Best:
    """The best ``k`` rows of each of ``n`` targets."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.last = np.full(n, np.iinfo(np.int64).min)
        self.columns = [np.zeros(0, np.int64) for _ in range(4)]  # target, score, key, uid

    def add(self, targets, scores, keys, uids) -> None:
        if not len(targets):
            return
        new = [np.concatenate(c) for c in zip(self.columns, (targets, scores, keys, uids), strict=True)]
        order = np.lexsort((new[3], new[2], -new[1], new[0]))
        target = new[0][order]
        starts = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
        place = np.arange(len(target)) - np.repeat(starts, np.diff(np.append(starts, len(target))))
        order = order[place < self.k]
        self.columns = [c[order] for c in new]
        full = np.bincount(self.columns[0], minlength=len(self.last)) == self.k
        ends = np.append(np.flatnonzero(np.diff(self.columns[0])), len(order) - 1)
        ends = ends[full[self.columns[0][ends]]]
        self.last[self.columns[0][ends]] = self.columns[1][ends]


def read_block(row: dict) -> Vectors:
    n, dim = row["n"], row["dim"]
    uids, keys, labels = (np.frombuffer(row[c], "<i8") for c in ("uids", "keys", "labels"))
    vectors = np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(n, dim)
    means, deviations = (np.frombuffer(row[c], "<f8").reshape(n, -1) for c in ("means", "deviations"))
    return Vectors(dim, uids, keys, labels, vectors, means, deviations)


def store(
    vectors: DataFrame, anchor: Column, scale: float = 256, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label"
) -> DataFrame:
    """Write blocks of the vectors that take part; ``anchor`` tells which of them are anchors."""
    named = vectors.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NULL_KEY)).alias("key"),
        (F.col(f"`{label}`") if isinstance(label, str) else label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    narrow = named.where("label IS NOT NULL AND vector IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33
        held: dict[int, list] = {}
        for batch in batches:
            column = batch.column("vector")
            offsets = column.offsets.to_numpy().astype(np.int64)
            values = column.values.fill_null(np.nan).to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            offsets = offsets - offsets[0]
            sizes = np.diff(offsets)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            whole = np.floor(scale * values)
            bad = np.bincount(owner[~np.isfinite(whole)], minlength=len(sizes)) > 0
            squares = np.bincount(owner, np.where(np.isfinite(whole), whole, 0) ** 2, minlength=len(sizes))
            bad |= (squares >= 2.0**62) | (sizes == 0)
            keys, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "label"))
            anchors = batch.column("anchor").to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes[~bad]).tolist():
                own = np.flatnonzero(~bad & (sizes == dim))
                new = [keys[own], labels[own], anchors[own], whole[offsets[own][:, None] + np.arange(dim)]]
                old = held.get(dim)
                held[dim] = new = [np.concatenate(x) for x in zip(old, new, strict=True)] if old else new
                while len(new[0]) >= ROWS:
                    yield _block(uid, [x[:ROWS] for x in new])
                    uid += ROWS
                    held[dim] = new = [x[ROWS:] for x in new]
        for new in held.values():
            if len(new[0]):
                yield _block(uid, new)
                uid += len(new[0])

    return materialize(narrow.mapInArrow(run, BLOCKS), "vector-blocks")


def _block(uid: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    order = np.lexsort((columns[0], columns[1]))  # rows of a label stand together
    keys, labels, anchors, vectors = (c[order] for c in columns)
    most = np.abs(vectors).max(initial=0)
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    means, deviations = summary(vectors)
    uids = uid + order
    packed = [(uids, "<i8"), (keys, "<i8"), (labels, "<i8"), (anchors, "u1"), (vectors, f"<i{width}"), (means, "<f8"), (deviations, "<f8")]
    numbers = [pa.array([x], pa.int32()) for x in (len(keys), vectors.shape[1], width)]
    content = [pa.array([np.ascontiguousarray(c.astype(k)).tobytes()], pa.binary()) for c, k in packed]
    return pa.RecordBatch.from_arrays([*numbers, *content], [c.split(" ")[0] for c in BLOCKS.split(", ")])


def anchors_of(blocks: DataFrame) -> DataFrame:
    """The anchors, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = read_block(row)
                chosen = np.flatnonzero(np.frombuffer(row["anchors"], "u1"))
                numbers = [pa.array(x[chosen], pa.int64()) for x in (block.uids, block.keys, block.labels)]
                vectors = pa.array([v.astype("<i8").tobytes() for v in block.exact[chosen]], pa.binary())
                yield pa.RecordBatch.from_arrays([*numbers, vectors], ["uid", "key", "label", "vector"])

    return blocks.mapInArrow(run, "uid long, key long, label long, vector binary")


def _collected(anchors: pa.Table) -> list[Vectors]:
    """Anchors by vector size, those of a label together."""
    sizes = np.array([len(v) // 8 for v in anchors["vector"].to_pylist()], np.int64)
    found = []
    for dim in np.unique(sizes).tolist():
        part = anchors.filter(pa.array(sizes == dim)).sort_by([("label", "ascending"), ("uid", "ascending")])
        uids, keys, labels = (part[c].to_numpy() for c in ("uid", "key", "label"))
        vectors = np.frombuffer(b"".join(part["vector"].to_pylist()), "<i8").reshape(len(uids), dim)
        found.append(Vectors(dim, uids, keys, labels, vectors, *summary(vectors.astype(float))))
    return found


def _scan(blocks: DataFrame, sent, work, k: int, targets: int) -> DataFrame:
    """The best ``k`` rows of ``targets`` targets per anchor in each task; ``work`` adds a block's to ``Best``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = opened(sent)
        best = [Best(len(g[0].uids) * targets, k) for g in groups]
        for batch in batches:
            for row in batch.to_pylist():
                block = read_block(row)
                for group, own in zip(groups, best, strict=True):
                    if group[0].dim == block.dim:
                        for low in range(0, len(group[0].uids), TILE):
                            work(group, np.arange(low, min(low + TILE, len(group[0].uids))), block, own)
        for group, own in zip(groups, best, strict=True):
            target, score, key, uid = own.columns
            for low in range(0, len(target), 1 << 16):
                part = slice(low, low + (1 << 16))
                columns = [group[0].uids[target[part] // targets], target[part] % targets, score[part], key[part], uid[part]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], FOUND)

    return blocks.mapInArrow(run, ", ".join(f"{c} long" for c in FOUND))


FOUND = ["anchor", "target", "score", "key", "uid"]


def _add_positives(group, tile: np.ndarray, block: Vectors, best: Best) -> None:
    """Rows of the anchors' own labels."""
    anchors = group[0].pick(tile)
    for label in np.unique(anchors.labels):
        low, high = np.searchsorted(block.labels, [label, label + 1])
        if low == high:
            continue
        own, rows = np.flatnonzero(anchors.labels == label), block.pick(np.arange(low, high))
        part = anchors.pick(own)
        others = part.uids[:, None] != rows.uids[None, :]
        a, r, scores = filtered(part, rows, others, best.last[tile[own]], None)
        best.add(tile[own][a], scores, rows.keys[r], rows.uids[r])


def _add_negatives(group, tile: np.ndarray, block: Vectors, best: Best) -> None:
    """Rows of other labels inside the windows of the anchors' positives."""
    vectors, least, most = group  # windows: one column per positive, empty where there is none
    wanted, k = np.maximum(best.last.reshape(most.shape)[tile], least[tile]), most.shape[1]
    some = np.flatnonzero((wanted <= most[tile]).any(axis=1))
    if not len(some):
        return
    tile, wanted = tile[some], wanted[some]
    anchors, high = vectors.pick(tile), most[tile]
    valid = wanted <= high
    low = np.where(valid, wanted, np.iinfo(np.int64).max).min(axis=1)
    top = np.where(valid, high, np.iinfo(np.int64).min).max(axis=1)
    others = anchors.labels[:, None] != block.labels[None, :]
    a, r, scores = filtered(anchors, block, others, low, top)
    for j in range(k):
        fits = (scores >= wanted[a, j]) & (scores <= high[a, j])
        best.add(tile[a[fits]] * k + j, scores[fits], block.keys[r[fits]], block.uids[r[fits]])


def mine(
    blocks: DataFrame, positives: int = 5, negatives: int = 5, percent: int = 80, anchor_bytes: int = ANCHOR_BYTES
) -> DataFrame:
    """Per anchor and positive its hardest negatives: rows that score at least ``percent`` of the positive, and no more than it.

    Columns: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    spark = blocks.sparkSession
    anchors = materialize(anchors_of(blocks), "anchors")
    # An anchor's vector as whole numbers and doubles, its summaries, and its best rows.
    room = F.sum(2 * F.length("vector") + 16 * sum(LEVELS) + 48 * (positives + positives * negatives))
    n_blocks = max(1, -(-(anchors.agg(room).first()[0] or 0) // anchor_bytes))
    found = None
    for number in range(n_blocks):
        part = anchors.where(F.pmod(F.xxhash64("uid"), F.lit(n_blocks)) == number).toArrow()
        if not part.num_rows:
            continue
        own = _mine_block(blocks, _collected(part), positives, negatives, percent)
        found = own if found is None else found.unionByName(own)
    return spark.createDataFrame([], RESULT) if found is None else found


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "target").orderBy(F.desc("score"), "key", "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _mine_block(blocks: DataFrame, anchors: list[Vectors], positives: int, negatives: int, percent: int) -> DataFrame:
    spark = blocks.sparkSession
    sent = broadcast(spark, [(group,) for group in anchors])
    # At most ``positives`` rows for each anchor of the block.
    best = _ranked(_scan(blocks, sent, _add_positives, positives, 1), positives)
    table = best.select("anchor", "rank", "score", "key").toArrow()
    groups, rows = [], []
    place = {int(u): (g, i) for g, group in enumerate(anchors) for i, u in enumerate(group.uids)}
    for group in anchors:
        shape = (len(group.uids), positives)
        groups.append((group, np.full(shape, np.iinfo(np.int64).max), np.full(shape, np.iinfo(np.int64).min)))
    for uid, rank, score, key in zip(*[table[c].to_pylist() for c in ("anchor", "rank", "score", "key")], strict=True):
        g, i = place[uid]
        if score >= 0:  # else the window is empty
            groups[g][1][i, rank - 1], groups[g][2][i, rank - 1] = -(-percent * score // 100), score
        rows.append((uid, rank - 1, int(anchors[g].keys[i]), key, score))
    known = spark.createDataFrame(rows, "anchor long, target long, anchor_id long, positive_id long, positive_score long")
    windows = broadcast(spark, groups)
    hard = _ranked(_scan(blocks, windows, _add_negatives, negatives, positives), negatives)

    def shown(name: str) -> Column:
        return F.when(F.col(name) != NULL_KEY, F.col(name))

    return hard.join(known, ["anchor", "target"]).select(
        shown("anchor_id").alias("anchor_id"),
        shown("positive_id").alias("positive_id"),
        "rank",
        shown("key").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
