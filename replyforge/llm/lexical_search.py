"""Ranked lexical search with Block-Max MaxScore over a sharded inverted index.

``build`` writes the index of all documents, in one narrow step. A task cuts its documents into shards of about
``SHARD_TERMS`` terms; a shard numbers its documents by length and has one row per term: its postings as gaps and
counts, narrow unsigned numbers in blocks of ``BLOCK``, and in front of each block its first document and its largest
count. Documents of a block are about equally long, so largest count and least length bound what a block can score,
whatever the corpus has on average. Counts of the whole corpus are sums over shard rows; an index stays right when
shards are added.

``search`` takes its queries in blocks. Only the posting lists of a block's terms travel, each shard's to one task.
For each query there, lists are sorted by their largest possible score. The lists that cannot lift a document over the
k-th best score so far even together are non-essential: documents are taken from the others, a stretch of the shard at
a time, and completed list by list. The block that could hold a document says how much it can add at most; a document
that cannot reach the k-th best score with that is dropped before the block is unpacked. The k best of each shard
are merged in the end.

A score is the sum over a query's terms, repeats included, of ``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` with
``m = 25 + (75 * n * N) div L`` and ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``; N documents have a term, L is
the number of all their terms, n of one document's, df of the documents with the term. Equal scores are ordered by
key. Terms are compared as bytes, never as hashes.

Terms are runs of ASCII letters and digits and of all that is not ASCII; A-Z becomes lower case. Documents without
text or terms count nowhere and are never found. Every document row stands for itself, also when rows repeat; keys have
to be long integers, null ones come first among equal scores. A query is a distinct pair of id and text; one without
terms, or whose terms no document has, gives no row. Texts of any length are indexed whole, a longer one than a shard
as a shard of its own. Columns other than id, key and text are not read, whatever their names. Without documents or
queries the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyforge.llm.batches import groups, per_process, utf8
from replyforge.llm.words import _alnum, _lower, spans
from replyforge.sources.storage import materialize

#: Terms and documents of a shard.
SHARD_TERMS = 1 << 21
SHARD_DOCS = 1 << 16
#: Postings of a block.
BLOCK = 64
#: Terms of the queries that are answered together.
QUERY_TERMS = 1 << 19
#: Documents looked at before the first look at the k-th best score, and at most between two.
STRETCH = (512, 16_384)
#: Tasks that the shards are dealt to, at most.
MAX_TASKS = 20_000
NULL_KEY = -(1 << 63)

#: One row per term of a shard, and one without a term that has its documents: keys as ``gaps``, lengths as ``tfs``.
INDEX = "shard long, term binary, df long, n_terms long, width int, gaps binary, tfs binary, firsts binary, tops binary"


def terms_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, term rows, lengths, the terms' bytes one after another) for groups of texts."""
    data, offsets = utf8(column)
    lower, alnum = per_process("lower", _lower), per_process("alnum", _alnum)
    for low, high in groups(np.diff(offsets)):
        text = lower[data[offsets[low] : offsets[high]]]
        inside = alnum[text]
        starts, ends, rows = spans(inside, offsets[low : high + 1] - offsets[low])
        yield low, high - low, rows, ends - starts, text[inside]


def numbered(lengths: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each term, and the distinct terms."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(content))]
    coded = pa.Array.from_buffers(pa.large_binary(), len(lengths), buffers).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def cut_rows(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of an array as binary values."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.large_binary(), len(counts), buffers).cast(pa.binary())


class ShardBuilder:
    """Collects documents until they fill a shard."""

    def __init__(self):
        self.next = TaskContext.get().partitionId() << 33
        self.clear()

    def clear(self) -> None:
        self.keys: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.content: list[np.ndarray] = []
        self.n_docs = self.n_terms = 0

    def add(self, keys: np.ndarray, rows: np.ndarray, lengths: np.ndarray, content: np.ndarray) -> None:
        self.keys.append(keys)
        self.rows.append(rows + self.n_docs)
        self.lengths.append(lengths)
        self.content.append(content)
        self.n_docs += len(keys)
        self.n_terms += len(rows)

    def full(self) -> bool:
        return self.n_terms >= SHARD_TERMS or self.n_docs >= SHARD_DOCS

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The rows of the shard."""
        if not self.n_terms:
            self.clear()
            return
        rows, shard = np.concatenate(self.rows), self.next
        codes, terms = numbered(np.concatenate(self.lengths), np.concatenate(self.content))
        sizes = np.bincount(rows, minlength=self.n_docs)
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        number = np.zeros(self.n_docs, np.int64)
        number[order] = np.arange(len(order))
        keys = np.concatenate(self.keys)[order]
        n_docs, total = len(order), self.n_terms
        places = codes.astype(np.int64) * n_docs + number[rows]
        self.clear()
        self.next += 1
        yield _batch(shard, [None], [n_docs], [total], 8, *[cut_rows(v.astype("<i8"), [n_docs]) for v in (keys, sizes[order])], pa.array([b""], pa.binary()), pa.array([b""], pa.binary()))

        places.sort()
        heads = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
        tfs = np.diff(np.append(heads, len(places)))
        code, doc = np.divmod(places[heads], n_docs)
        df = np.bincount(code, minlength=len(terms))
        starts = np.cumsum(df) - df
        first = (np.arange(len(doc)) - starts[code]) % BLOCK == 0
        gaps = np.where(first, 0, np.diff(doc, prepend=0))
        tops = np.maximum.reduceat(tfs, np.flatnonzero(first))
        widest = np.maximum.reduceat(np.maximum(gaps, tfs), starts)
        width = np.select([widest < 1 << 8, widest < 1 << 16], [1, 2], 4)
        n_blocks = -(-df // BLOCK)
        for size in (1, 2, 4):
            chosen = np.flatnonzero(width == size)
            for low in range(0, len(chosen), 1 << 15):
                part = chosen[low : low + (1 << 15)]
                own = np.zeros(len(terms), bool)
                own[part] = True
                posting, block = own[code], own[code[first]]
                kind = f"<u{size}"
                yield _batch(
                    shard,
                    terms.take(pa.array(part)).cast(pa.binary()),
                    df[part],
                    [0] * len(part),
                    size,
                    cut_rows(gaps[posting].astype(kind), df[part]),
                    cut_rows(tfs[posting].astype(kind), df[part]),
                    cut_rows(doc[first][block].astype("<u4"), n_blocks[part]),
                    cut_rows(tops[block].astype("<u4"), n_blocks[part]),
                )


def _batch(shard, terms, df, n_terms, width, *packed) -> pa.RecordBatch:
    n = len(df)
    columns = [pa.array([shard] * n, pa.int64()), pa.array(terms, pa.binary()) if isinstance(terms, list) else terms]
    columns += [pa.array(df, pa.int64()), pa.array(n_terms, pa.int64()), pa.array([width] * n, pa.int32()), *packed]
    return pa.RecordBatch.from_arrays(columns, [c.split(" ")[0] for c in INDEX.split(", ")])


def build(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the index of all documents below the shared folder and answer its table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = ShardBuilder()
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for low, n, rows, lengths, content in terms_of(batch.column(1)):
                shard.add(keys[low : low + n], rows, lengths, content)
                if shard.full():
                    yield from shard.batches()
        yield from shard.batches()

    narrow = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NULL_KEY)).alias("key"), F.col(f"`{text}`").alias("text")
    )
    return materialize(narrow.mapInArrow(run, INDEX), "lexical-index")


class Postings:
    """A term's list in a shard; blocks are unpacked when they are asked for, and kept for the next query."""

    def __init__(self, row: dict, m: np.ndarray):
        kind = f"<u{row['width']}"
        self.gaps, self.tfs = np.frombuffer(row["gaps"], kind), np.frombuffer(row["tfs"], kind)
        self.firsts = np.frombuffer(row["firsts"], "<u4").astype(np.int64)
        self.m = m
        # The first document of a block is its shortest.
        self.limits = impact(np.frombuffer(row["tops"], "<u4").astype(np.int64), m[self.firsts])
        self.limit = int(self.limits.max())
        shape = (len(self.firsts), BLOCK)
        self.docs, self.impacts = np.full(shape, len(m), np.int32), np.zeros(shape, np.int32)
        self.ready = np.zeros(len(self.firsts), bool)

    def unpack(self, blocks: np.ndarray) -> None:
        new = blocks[~self.ready[blocks]]
        if not len(new):
            return
        places = new[:, None] * BLOCK + np.arange(BLOCK)
        there = places < len(self.gaps)
        places = np.minimum(places, len(self.gaps) - 1)
        docs = np.cumsum(self.gaps[places] * there, axis=1, dtype=np.int64) + self.firsts[new][:, None]
        self.docs[new] = np.where(there, docs, len(self.m))
        self.impacts[new] = impact(self.tfs[places].astype(np.int64) * there, self.m[docs])
        self.ready[new] = True


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Searcher:
    """The lists of a shard."""

    def __init__(self, table: pa.Table, n_docs: int, n_terms: int):
        rows = table.to_pylist()
        own = next(r for r in rows if r["term"] is None)
        self.keys = np.frombuffer(own["gaps"], "<i8")
        lengths, which = np.unique(np.frombuffer(own["tfs"], "<i8"), return_inverse=True)
        m = np.array([25 + 75 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)[which]
        self.lists = {r["term"]: Postings(r, m) for r in rows if r["term"] is not None}
        self.scores = np.zeros(len(self.keys), np.int64)

    def best(self, weights: list[tuple[bytes, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and keys of the ``k`` best documents with a score above 0."""
        lists = [(w, self.lists[t]) for t, w in weights if w and t in self.lists]
        lists.sort(key=lambda x: x[0] * x[1].limit)
        upto = np.cumsum([w * p.limit for w, p in lists])
        best, keys, floor = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
        low, stretch = 0, STRETCH[0]
        while low < len(self.keys):
            essential = int(np.searchsorted(upto, floor, "left"))
            if essential == len(lists):
                break  # no document reaches the k-th best score any more
            high = min(low + stretch, len(self.keys))
            found, scores = self._completed(lists, upto, essential, floor, low, high)
            if len(found):
                best, keys = np.concatenate([best, scores]), np.concatenate([keys, self.keys[found]])
                order = np.lexsort((keys, -best))[:k]
                best, keys = best[order], keys[order]
                if len(best) == k:
                    floor = max(1, int(best[-1]))
            low, stretch = high, min(2 * stretch, STRETCH[1])
        return best, keys

    def _completed(self, lists, upto, essential: int, floor: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``low`` to ``high`` that score ``floor`` at least."""
        for w, p in lists[essential:]:
            a = max(0, int(np.searchsorted(p.firsts, low, "right")) - 1)
            b = int(np.searchsorted(p.firsts, high, "left"))
            if a >= b:
                continue
            p.unpack(np.arange(a, b))
            docs = p.docs[a:b].ravel()
            inside = (docs >= low) & (docs < high)
            self.scores[docs[inside]] += w * p.impacts[a:b].ravel()[inside].astype(np.int64)
        found = low + np.flatnonzero(self.scores[low:high])
        scores = self.scores[found]
        self.scores[low:high] = 0
        for i in range(essential - 1, -1, -1):
            w, p = lists[i]
            block = np.searchsorted(p.firsts, found, "right") - 1
            most = np.where(block >= 0, w * p.limits[block], 0) + (upto[i - 1] if i else 0)
            keep = scores + most >= floor
            found, scores, block = found[keep], scores[keep], block[keep]
            if not len(found):
                break
            has = np.flatnonzero(block >= 0)
            p.unpack(np.unique(block[has]))
            same = p.docs[block[has]] == found[has][:, None]
            scores[has] += w * (p.impacts[block[has]] * same).sum(axis=1, dtype=np.int64)
        keep = scores >= floor
        return found[keep], scores[keep]


def query_terms(queries: DataFrame) -> DataFrame:
    """``query, term, times`` of queries with ``query`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for low, n, rows, lengths, content in terms_of(batch.column(1)):
                if not len(rows):
                    continue
                codes, terms = numbered(lengths, content)
                places, times = np.unique(rows * len(terms) + codes, return_counts=True)
                row, code = np.divmod(places, len(terms))
                columns = [pa.array(own[low + row], pa.int64()), terms.take(pa.array(code)).cast(pa.binary()), pa.array(times, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["query", "term", "times"])

    return queries.select("query", "text").mapInArrow(run, "query long, term binary, times long")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(
    index: DataFrame, queries: DataFrame, k: int = 10, item: str = "item_id", text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``item``, ``rank``, ``key`` and ``score`` of the ``k`` best documents of every query."""
    spark = index.sparkSession
    n_docs, n_terms, n_shards = index.where("term IS NULL").agg(F.sum("df"), F.sum("n_terms"), F.count("*")).first()
    named = queries.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").alias("text")).distinct()
    asked = materialize(named.withColumn("query", F.monotonically_increasing_id()), "lexical-queries")
    terms = materialize(query_terms(asked), "lexical-terms")
    n_blocks = max(1, -(-terms.count() // QUERY_TERMS))
    found = None
    for block in range(n_blocks if n_docs else 0):
        part = terms.where(F.pmod(F.xxhash64("query"), F.lit(n_blocks)) == block)
        answered = materialize(_answer(index, part, n_docs, n_terms, min(n_shards, MAX_TASKS), k), "lexical-shards")
        found = answered if found is None else found.unionByName(answered)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked, "query").select(
        F.col("item").alias(item), "rank", F.when(F.col("key") != NULL_KEY, F.col("key")).alias(key), "score"
    )


FOUND = "query long, score long, key long"


def _answer(index: DataFrame, terms: DataFrame, n_docs: int, n_terms: int, tasks: int, k: int) -> DataFrame:
    """The ``k`` best documents of each shard for a block of queries."""
    spark = index.sparkSession
    wanted = F.broadcast(terms.select("term").distinct())  # at most the terms of a block
    counts = index.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weighed = terms.join(counts, "term").select("query", "term", "times", "df").toArrow()
    asked: dict[int, list[tuple[bytes, int]]] = {}
    weights = {d: weight(n_docs, d) for d in set(weighed["df"].to_pylist())}
    for query, term, times, df in zip(*[weighed[c].to_pylist() for c in ("query", "term", "times", "df")], strict=True):
        asked.setdefault(query, []).append((term, times * weights[df]))
    sent = spark.sparkContext.broadcast(asked)

    def run(table: pa.Table) -> pa.Table:
        shard = Searcher(table, n_docs, n_terms)
        queries, scores, keys = [], [], []
        for query, own in sent.value.items():
            best, docs = shard.best(own, k)
            queries.append(np.full(len(best), query, np.int64))
            scores.append(best)
            keys.append(docs)
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (queries, scores, keys)]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["query", "score", "key"])

    lists = index.join(wanted, "term", "left_semi").unionByName(index.where("term IS NULL"))
    # A stated number: by their bytes, shards of short lists would be merged into few tasks.
    return lists.repartition(tasks, "shard").groupBy("shard").applyInArrow(run, FOUND)
