"""Language identification by prediction by partial matching.

For each language a context tree over bytes holds how often each byte followed each context of up to ``order`` bytes.
A byte seen in a context costs ``-log2(count / (total + distinct))`` bits there; an unseen one costs the escape
``-log2(distinct / (total + distinct))`` and is coded in the next shorter context, down to 8 bits for a byte without
any context. Counts are frozen after learning. The language with the shortest code of the whole text wins, and the
score is its share when code lengths are read as probabilities.

Learning counts at most ``per_language`` documents of each language (those with the smallest hash of key and text) and keeps
the ``max_contexts`` most frequent contexts. From the counts one table is made: the cost of every symbol after every
context, for all languages side by side; the context of a position is the longest one in the tree. Three newlines stand
in front of each text as its first context.

Null texts and texts without a letter are ``und`` with score 0. Rows with null key or language are not learnt from. Of
languages with equal code lengths the first by name wins. Without anything learnt every text is ``und``. Key, text and
language are the only columns read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyforge.llm.batches import groups, utf8

ORDER = 3
UNKNOWN = "und"


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ``ORDER`` newlines in front of each, and the place of each text's bytes."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    places = np.arange(len(rows)) + ORDER * (rows + 1)
    out = np.full(len(rows) + ORDER * (len(offsets) - 1), 10, np.uint8)
    out[places] = data
    return out, places


def context_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys ``order << 32 | context and byte`` of all orders, and how often each occurs."""
    text, places = padded(data, offsets)
    keys, counts, window = [], [], np.zeros(len(places), np.uint64)
    for order in range(ORDER + 1):
        window = window | (text[places - order].astype(np.uint64) << np.uint64(8 * order))
        found, n = np.unique(window, return_counts=True)
        keys.append(found | np.uint64(order << 32))
        counts.append(n)
    return np.concatenate(keys), np.concatenate(counts)


@dataclass
class Model:
    languages: list[str]
    symbols: np.ndarray  # byte -> symbol; the last symbol stands for all bytes never seen
    nodes: np.ndarray  # three symbols -> context
    costs: np.ndarray  # (context * symbols + symbol, language) -> bits

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        width = int(self.symbols.max()) + 1
        for low, high in groups(np.diff(offsets), 1 << 18):
            local = offsets[low : high + 1] - offsets[low]
            if not local[-1]:
                continue
            text, places = padded(data[offsets[low] : offsets[high]], local)
            signs = self.symbols[text]
            before = (signs[places - 3] * width + signs[places - 2]) * width + signs[places - 1]
            bits = self.costs[self.nodes[before] * width + signs[places]]
            full = np.flatnonzero(np.diff(local))
            out[low + full] = np.add.reduceat(bits, local[:-1][full], axis=0, dtype=np.float64)
        return out


def build(counted: dict[str, tuple[np.ndarray, np.ndarray]], max_contexts: int) -> Model:
    """The cost table from the counts of each language."""
    languages = sorted(counted)
    both = np.concatenate([counted[name][0] for name in languages] or [np.zeros(0, np.uint64)])
    # The newlines in front of texts are contexts, too; a byte never seen is in no context.
    seen = np.unique(np.append((both & np.uint64(255)).astype(np.int64), 10))
    width = len(seen) + 1
    symbols = np.full(256, width - 1, np.int64)
    symbols[seen] = np.arange(len(seen))

    # Contexts of all languages, the most frequent first; a context's suffix is at least as frequent and shorter.
    totals: dict[int, int] = {}
    for name in languages:
        keys, n = counted[name]
        contexts, place = np.unique((keys >> np.uint64(32) << np.uint64(32)) | ((keys & np.uint64(0xFFFFFFFF)) >> np.uint64(8)), return_inverse=True)
        for context, total in zip(contexts.tolist(), np.bincount(place, n).astype(int).tolist(), strict=True):
            totals[context] = totals.get(context, 0) + total
    chosen = sorted(totals, key=lambda c: (-totals[c], c >> 32, c))[:max_contexts]
    chosen = sorted({0, *chosen}, key=lambda c: (c >> 32, c))  # by length
    number = {c: i for i, c in enumerate(chosen)}

    def suffix(context: int) -> int:
        order = context >> 32
        return (order - 1) << 32 | (context & ((1 << 8 * (order - 1)) - 1))

    costs = np.full((len(chosen), width, len(languages)), 8.0)
    ordered = np.array(chosen, np.uint64)
    for at, name in enumerate(languages):
        keys, n = counted[name]
        contexts = (keys >> np.uint64(32) << np.uint64(32)) | ((keys & np.uint64(0xFFFFFFFF)) >> np.uint64(8))
        order = np.argsort(contexts, kind="stable")
        contexts, bytes_, n = contexts[order], symbols[(keys[order] & np.uint64(255)).astype(np.int64)], n[order]
        firsts = np.searchsorted(contexts, ordered, "left")
        lasts = np.searchsorted(contexts, ordered, "right")
        for i, context in enumerate(chosen):
            row = costs[number[suffix(context)], :, at].copy() if context else np.full(width, 8.0)
            if lasts[i] > firsts[i]:
                own = n[firsts[i] : lasts[i]]
                whole = own.sum() + len(own)
                row -= np.log2(len(own) / whole)
                row[bytes_[firsts[i] : lasts[i]]] = -np.log2(own / whole)
            costs[i, :, at] = row

    # The longest context in the tree for every three symbols.
    nodes = np.zeros((width, width, width), np.int32)
    for context in chosen:
        order, c = context >> 32, context & 0xFFFFFFFF
        s = [int(symbols[(c >> (8 * k)) & 255]) for k in range(order)]
        if order == 1:
            nodes[:, :, s[0]] = number[context]
        elif order == 2:
            nodes[:, s[1], s[0]] = number[context]
        elif order == 3:
            nodes[s[2], s[1], s[0]] = number[context]
    return Model(languages, symbols, nodes.ravel(), costs.reshape(-1, max(1, len(languages))).astype(np.float32)[:, : len(languages)])


def learn(
    docs: DataFrame,
    learnable: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = 300,
    max_contexts: int = 8000,
) -> Model:
    """Count contexts in a bounded sample of the rows that meet ``learnable``, a condition on ``docs``."""
    known = docs.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{key}`").isNotNull() & learnable).select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")
    )
    # Rows are drawn by the hash of all they hold, so one key that many rows share draws no more and no fewer of them.
    drawn = known.withColumn("place", F.xxhash64("key", "text"))
    share = F.col("place").bitwiseAND((1 << 30) - 1) / F.lit(float(1 << 30))
    sizes = drawn.groupBy("lang").agg(F.count("*").alias("count"), F.min(share).alias("least"))
    # One row per language, as in the model itself. A threshold lets about twice the wanted rows through, and at least one, so that the exact choice below sees few.
    few = drawn.join(F.broadcast(sizes), "lang").where(share <= F.greatest((2.0 * per_language + 20) / F.col("count"), F.col("least")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "key", "text"))
    sample = few.withColumn("n", rank).where(F.col("n") <= per_language).select("lang", "text")

    def run(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            for name in sorted(set(names)):
                part = batch.filter(pa.array([n == name for n in names]))
                data, offsets = utf8(part.column(1))
                keys, n = context_counts(data[offsets[0] : offsets[-1]], offsets - offsets[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "k", "n"],
                )

    counts = sample.mapInArrow(run, "lang string, k long, n long").groupBy("lang", "k").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    names, keys, n = (found[c].to_numpy() for c in ("lang", "k", "n"))
    by_language = {name: (keys[names == name].astype(np.uint64), n[names == name]) for name in sorted(set(names))}
    return build(by_language, max_contexts)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    sums = np.append(0, np.cumsum(ascii_letter, dtype=np.int64))
    found = sums[offsets[1:] - offsets[0]] > sums[offsets[:-1] - offsets[0]]
    for i in np.flatnonzero(~found):
        rest = data[offsets[i] - offsets[0] : offsets[i + 1] - offsets[0]].tobytes()
        found[i] = bool(rest) and regex.search(r"\p{L}", rest.decode("utf-8", "replace")) is not None
    return found


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``lang_pred`` and ``score`` of every row."""
    kind = docs.schema[key].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)  # size set by max_contexts, alphabet and languages

    def run(batches):
        known = sent.value
        names = np.array([*known.languages, UNKNOWN], object)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            letters = has_letter(data[offsets[0] : offsets[-1]], offsets)
            if known.languages:
                bits = known.code_lengths(data, offsets)
                best = bits.argmin(axis=1)
                share = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
            else:
                best, share = np.zeros(len(letters), np.int64), np.zeros(len(letters))
            best = np.where(letters & (len(known.languages) > 0), best, len(known.languages))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(np.where(best < len(known.languages), share, 0.0))],
                ["key", "lang_pred", "score"],
            )

    return (
        docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
        .mapInArrow(run, f"key {kind}, lang_pred string, score double")
        .withColumnRenamed("key", key)
    )
