"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a row of numbers (shares of character kinds, word and line repetition, lengths). The model is one
lookup table per feature and one per chosen pair of features, learnt by boosting shallow trees in a fixed cycle over
the features, then over the pairs; the trees of a feature add up to its table. A score is the logistic function of the
sum of the looked-up values, computed for whole batches at a time.

Learning uses at most ``max_rows`` labelled rows (those with the smallest hash of the key, so the same ones every
time); only their features reach the driver. Everything else covers all rows.

Null and empty texts have all features 0 and get a score like any other. Null keys, null labels and labels other than 0
and 1 are not learnt from; of repeated labels of a key the largest counts. With no learnable row, or rows of one label
only, the score is the share of label 1 (0.5 with none). Only key and text are read; other columns may have any name.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyforge.llm.batches import groups, mixed, per_process, span_hashes, utf8

FEATURES = [
    "log_bytes", "log_words", "word_length", "upper", "digits", "marks", "symbols", "loud", "wide", "line_words",
    "distinct_words", "top_word", "same_next", "distinct_pairs", "repeated_lines", "marked_words",
]


def _byte_kinds() -> np.ndarray:
    """Per byte: upper, digit, mark, symbol, exclamation or question mark, above ASCII, space, newline."""
    kinds = np.zeros((256, 8), bool)
    for b in range(128):
        c = chr(b)
        mark = not c.isalnum() and b > 32 and b != 127
        kinds[b] = [c.isupper(), c.isdigit(), mark, c in "#*$%&|<>@^~_{}[]\\/=+", c in "!?", 0, c in " \t\n\x0b\f\r", c == "\n"]
    kinds[128:, 5] = True
    return kinds


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of ``FEATURES`` for texts as UTF-8 bytes."""
    out = np.zeros((len(offsets) - 1, len(FEATURES)))
    for low, high in groups(np.diff(offsets)):
        local = offsets[low : high + 1] - offsets[low]
        if local[-1]:
            out[low:high] = _features(data[offsets[low] : offsets[high]], local)
    return out


def _share_distinct(rows: np.ndarray, hashes: np.ndarray, n: int, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: distinct hashes as a share of ``total``, and the share of the commonest."""
    keys = np.sort((rows.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    fresh = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    owner = (keys[fresh] >> np.uint64(40)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, owner, np.diff(np.append(fresh, len(keys))))
    return np.bincount(owner, minlength=n) / total, top / total


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n, size = len(offsets) - 1, np.diff(offsets)
    table = per_process("byte kinds", _byte_kinds)
    full = size > 0
    per_text = np.zeros((8, n))
    for k in range(8):
        per_text[k, full] = np.add.reduceat(table[:, k][data].view(np.uint8), offsets[:-1][full], dtype=np.int64)
    upper, digit, mark, symbol, loud, wide, space, newline = per_text
    blank = table[:, 6][data]
    edge = np.zeros(len(data), bool)
    edge[offsets[:-1][full]] = True
    before = np.append(True, blank[:-1]) | edge
    starts = np.flatnonzero(~blank & before)
    last = np.append(blank[1:], True) | np.append(edge[1:], True)
    ends = np.flatnonzero(~blank & last) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    words = np.bincount(row, minlength=n).astype(float)
    some, solid = np.maximum(words, 1), np.maximum(size - space, 1)
    hashes = span_hashes(data, starts, ends)
    distinct, top = _share_distinct(row, hashes, n, some)
    near = row[1:] == row[:-1]
    same = np.bincount(row[1:][near & (hashes[1:] == hashes[:-1])], minlength=n) / some
    pairs = mixed(hashes[1:] * np.uint64(3) + hashes[:-1])[near]
    distinct_pairs, _ = _share_distinct(row[1:][near], pairs, n, np.maximum(words - 1, 1))
    marked = np.bincount(row[table[:, 2][data[ends - 1]]], minlength=n) / some if len(ends) else np.zeros(n)
    cuts = np.flatnonzero(table[:, 7][data] | edge)
    line_starts = np.where(edge[cuts], cuts, cuts + 1)
    line_starts = np.unique(line_starts[line_starts < len(data)])
    line_row = np.searchsorted(offsets, line_starts, "right") - 1
    line_ends = np.minimum(np.append(line_starts[1:], len(data)), offsets[line_row + 1])
    long = line_ends - line_starts > 1
    lines = np.maximum(np.bincount(line_row[long], minlength=n), 1)
    distinct_lines, _ = _share_distinct(line_row[long], span_hashes(data, line_starts[long], line_ends[long]), n, lines)
    columns = np.stack(
        [
            np.log1p(size), np.log1p(words), solid / some, upper / solid, digit / solid, mark / solid, symbol / solid,
            loud / solid, wide / solid, words / (newline + 1), distinct, top, same, distinct_pairs,
            1 - distinct_lines, marked,
        ],
        axis=1,
    )
    return columns * full[:, None]


@dataclass
class Model:
    """``edges`` cut each feature into bins; ``tables`` and ``pairs`` hold what a bin, or two bins, add."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, rows: np.ndarray) -> np.ndarray:
        found = [np.searchsorted(e, rows[:, f], "right") for f, e in enumerate(self.edges)]
        return np.stack(found, axis=1) if found else np.zeros((len(rows), 0), np.int64)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.base)
        for f, table in enumerate(self.tables):
            total += table[bins[:, f]]
        for i, j, table in self.pairs:
            total += table[bins[:, i], bins[:, j]]
        return total

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(self.bins(rows))))


@dataclass(frozen=True)
class Settings:
    max_rows: int = 20_000
    max_bins: int = 32
    rounds: int = 120
    rate: float = 0.15
    pair_rounds: int = 40
    n_pairs: int = 6
    smooth: float = 2.0


def _gain(g: np.ndarray, h: np.ndarray, smooth: float) -> np.ndarray:
    return g * g / (h + smooth)


def _best_cut(g: np.ndarray, h: np.ndarray, smooth: float) -> tuple[float, int]:
    """Gain and place of the best cut of a range of bins; place 0: none."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h, smooth) + _gain(g.sum() - left_g, h.sum() - left_h, smooth) - _gain(g.sum(), h.sum(), smooth)
    at = int(np.argmax(gains))
    return float(gains[at]), at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, smooth: float) -> np.ndarray:
    """Values of a tree of depth two over the bins of one feature."""
    out = np.empty(len(g))
    _, middle = _best_cut(g, h, smooth)
    for low, high in ((0, middle), (middle, len(g))):
        if low == high:
            continue
        _, cut = _best_cut(g[low:high], h[low:high], smooth)
        for a, b in ((low, low + cut), (low + cut, high)):
            out[a:b] = g[a:b].sum() / (h[a:b].sum() + smooth)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray, smooth: float) -> tuple[float, np.ndarray]:
    """Gain and values of the better tree that cuts along one feature, then each side along the other."""
    best = (-1.0, np.zeros_like(g))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        _, middle = _best_cut(a.sum(1), b.sum(1), smooth)
        out, gain = np.empty(a.shape), -float(_gain(a.sum(), b.sum(), smooth))
        for low, high in ((0, middle), (middle, len(a))):
            if low == high:
                continue
            _, cut = _best_cut(a[low:high].sum(0), b[low:high].sum(0), smooth)
            for left, right in ((0, cut), (cut, a.shape[1])):
                s, t = a[low:high, left:right].sum(), b[low:high, left:right].sum()
                out[low:high, left:right] = s / (t + smooth)
                gain += float(_gain(s, t, smooth))
        if gain > best[0]:
            best = (gain, out.T if turned else out)
    return best


def fit(rows: np.ndarray, labels: np.ndarray, settings: Settings = Settings()) -> Model:
    """Learn the tables by cyclic boosting of the logistic loss."""
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or share in (0.0, 1.0):
        return Model(float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    quantiles = np.linspace(0, 1, settings.max_bins + 1)[1:-1]
    model = Model(float(np.log(share / (1 - share))), [np.unique(np.quantile(rows[:, f], quantiles)) for f in range(rows.shape[1])])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = model.bins(rows)
    margin = np.full(len(rows), model.base)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return labels - p, p * (1 - p)

    for _ in range(settings.rounds):
        for f, table in enumerate(model.tables):
            g, h = residuals()
            step = settings.rate * shallow_tree(
                np.bincount(bins[:, f], g, len(table)), np.bincount(bins[:, f], h, len(table)), settings.smooth
            )
            table += step
            margin += step[bins[:, f]]

    def squares(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = residuals()
        shape = len(model.tables[i]), len(model.tables[j])
        place = bins[:, i] * shape[1] + bins[:, j]
        return np.bincount(place, g, shape[0] * shape[1]).reshape(shape), np.bincount(place, h, shape[0] * shape[1]).reshape(shape)

    ranked = sorted(
        itertools.combinations(range(len(model.tables)), 2),
        key=lambda ij: -pair_tree(*squares(*ij), settings.smooth)[0],
    )
    model.pairs = [(i, j, np.zeros((len(model.tables[i]), len(model.tables[j])))) for i, j in ranked[: settings.n_pairs]]
    for _ in range(settings.pair_rounds):
        for i, j, table in model.pairs:
            step = settings.rate * pair_tree(*squares(i, j), settings.smooth)[1]
            table += step
            margin += step[bins[:, i], bins[:, j]]
    return model


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def learn(
    docs: DataFrame,
    labels: DataFrame,
    learnable: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    settings: Settings = Settings(),
) -> Model:
    """Fit on the labelled rows whose key meets ``learnable``, a condition on the labels' key column."""
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & learnable)
        .groupBy(F.col(key).alias("key"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(settings.max_rows)
    )

    def run(batches):
        for batch in batches:
            rows = text_features(*utf8(batch.column(0)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(list(rows), pa.list_(pa.float64()))], ["key", "label", "row"]
            )

    kind = docs.schema[key].dataType.simpleString()
    learnt = (
        docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{key}`").alias("key"))
        .join(F.broadcast(chosen), "key")  # at most max_rows rows of two numbers
        .select("text", "key", "label")
        .mapInArrow(run, f"key {kind}, label int, row array<double>")
        .orderBy("key", "row")
        .limit(settings.max_rows)  # only repeated keys could make more
        .toArrow()
    )
    rows = learnt["row"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return fit(rows, learnt["label"].to_numpy().astype(float), settings)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``score`` of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = model.score(text_features(*utf8(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["key", "score"])

    return (
        docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
        .mapInArrow(run, f"key {kind}, score double")
        .withColumnRenamed("key", key)
    )


def keep(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, with all their columns."""
    names = docs.columns
    place = names.index(text)

    def run(batches):
        for batch in batches:
            found = model.score(text_features(*utf8(batch.column(place))))
            yield batch.filter(pa.array(found >= threshold))

    return docs.mapInArrow(run, docs.schema)
