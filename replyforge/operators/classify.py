"""Linear text classifier as a weight table, and the retention figures of a filter run."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from replyforge.functions.spans import WordTable, distinct_words, fnv_hashes, gathered, run_buckets, runs, text_bytes
from replyforge.functions.text import _col, percent, round_even
from replyforge.operators.skew import with_running
from replyforge.shipping import broadcast, opened
from replyforge.sources.storage import materialize

# A weight table of at most this many bytes goes to the tasks whole.
BLOCK_BYTES = 64 * 1024 * 1024
# Bytes of rows whose words and runs ask a larger weight table together.
CHUNK_BYTES = 8 * 1024 * 1024
# Bytes of texts that are cut into words at once; the arrays for it take some fifty times as much.
PIECE_BYTES = 1024 * 1024
# Labels up to which a piece keeps that size.
PIECE_LABELS = 16

# What ends a word: NUL, tab to carriage return (newline included), blank (fixed values).
WORD_END = b"\x00\t\n\x0b\x0c\r "
# Words that begin like this are labels and no part of a text's runs (fixed value).
LABEL_MARK = b"__label__"


def label_number(label: Column | str) -> Column:
    """``__label__1`` becomes 1, other label text must be an integer; null when it is not."""
    return F.replace(_col(label).cast("string"), F.lit("__label__")).try_cast("int")


def _block(model: DataFrame, key: str, labels: list, n_blocks: int, block: int) -> tuple[pa.Array, np.ndarray]:
    """The keys of one block of a weight table and their (key, label) weights; repeated entries add up."""
    own = model if n_blocks == 1 else model.where(F.pmod(F.xxhash64(key), F.lit(n_blocks)) == block)
    rows = own.select(key, "label", F.col("weight").cast("double").alias("weight")).where(f"{key} IS NOT NULL").toArrow()
    keys = rows[key].combine_chunks().dictionary_encode()
    column = {label: i for i, label in enumerate(labels)}
    columns = rows["label"].combine_chunks().dictionary_encode()
    numbers = np.array([column[x] for x in columns.dictionary.to_pylist()], np.int64)
    table = np.zeros((len(keys.dictionary), len(labels)))
    if len(rows):
        places = (keys.indices.to_numpy(), numbers[columns.indices.to_numpy()])
        np.add.at(table, places, rows["weight"].to_numpy())
    return keys.dictionary, table


def add_sums(
    docs: DataFrame,
    model: DataFrame,
    text: str = "text",
    end: str | None = None,
    ngrams: int = 1,
    block_bytes: int = BLOCK_BYTES,
    buckets: DataFrame | None = None,
    n_buckets: int = 2_000_000,
) -> tuple[DataFrame, list]:
    """Every row of ``docs`` with ``_n`` (known tokens of its text) and ``_sums`` (their weights per label), and the labels.

    ``model`` has ``label, token, weight``. Without ``buckets`` a token may be a run of up to ``ngrams`` words joined by
    blanks. With them, runs are known by the bucket their rolling hash falls into, ``n_buckets`` in number, and ``buckets``
    has ``label, bucket, weight``; a bucket without weights counts as one with zeros.

    Tables of at most ``block_bytes`` go to the tasks, and no row is shuffled or joined. Larger ones are cut into blocks by
    the hash of their keys, which meet the distinct words of the texts in a join, so that what a task holds and what is
    written for a row do not depend on their size. A stream has no such step: there all blocks go to the tasks.
    """
    found = model.agg(F.collect_set("label").alias("labels"), F.sum(F.octet_length("token") + 100).alias("bytes"), F.count("*").alias("rows")).first()
    labels = sorted(found["labels"])
    if not labels:
        raise ValueError("the model has no labels")
    # Rows of a token are as many as it has labels, at most.
    n_blocks = max(1, -(-((found["bytes"] or 0) // len(labels) + 8 * found["rows"]) // block_bytes))
    n_parts = 0 if buckets is None else max(1, -(-buckets.count() * (8 + 100 // len(labels)) // block_bytes))
    summed = docs.withColumns({"_n": F.lit(0).cast("bigint"), "_sums": F.array_repeat(F.lit(0.0), len(labels))})
    split = Splitter(text, end.encode("utf-8") if end is not None else None, ngrams, len(labels))
    if max(n_blocks, n_parts) > 1 and not docs.isStreaming:
        return _met(summed, model, buckets, labels, split, n_buckets), labels
    steps = []
    for block in range(n_blocks):
        words, weights = _block(model, "token", labels, n_blocks, block)
        steps.append((_find_words, (WordTable.of(words), weights, buckets is None)))
    for block in range(n_parts):
        keys, weights = _block(buckets, "bucket", labels, n_parts, block)
        steps.append((_find_buckets, _bucket_table(keys, weights, n_buckets, block == 0)))
    sent = broadcast(docs.sparkSession, steps)
    return summed.mapInArrow(_adder(sent, split), summed.schema), labels


def _bucket_table(keys: pa.Array, weights: np.ndarray, n_buckets: int, first: bool) -> tuple:
    numbers = keys.to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(numbers)
    return numbers[order], weights[order], n_buckets, first


def _met(summed: DataFrame, model: DataFrame, buckets: DataFrame | None, labels: list, split: Splitter, n_buckets: int) -> DataFrame:
    """The sums by tables of any size: chunks of rows ask for the weights of their distinct words and runs.

    The rows are written once, with the number of their chunk, and moved once, to the weights that their chunk has got.
    """
    chunk, asks, words, runs_ = free_names(summed.columns, "_chunk", "_asks", "_words", "_runs")
    own = f"{chunk} BIGINT, {asks} BOOLEAN, {words} ARRAY<STRING>, {runs_} ARRAY<BIGINT>"
    # The row that asks for a chunk has none of the other columns.
    fields = [StructField(f.name, f.dataType, True, f.metadata) for f in summed.schema]
    schema = StructType([*fields, *StructType.fromDDL(own)])
    by_text, hashed = buckets is None, n_buckets if buckets is not None else 0
    chunks = materialize(summed.mapInArrow(_chunker(split, by_text, hashed, schema.names), schema), "chunks", compression="zstd")
    rows, asked = chunks.where(~F.col(asks)).drop(asks, words, runs_), chunks.where(asks)
    none = {"_word": F.lit(None).cast("string"), "_run": F.lit(None).cast("bigint")}
    found = []
    for table, key, column, name in ((model, "token", words, "_word"), (buckets, "bucket", runs_, "_run")):
        if table is not None:
            keys = asked.select(F.col(chunk).alias("_of"), F.explode(column).alias("_key"))
            met = keys.join(_by_key(table, key, labels), "_key")
            found.append(met.select("_of", *[(F.col("_key") if c == name else none[c]).alias(c) for c in none], "_weights"))
    weights = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    added = _weigher(split, to_arrow_schema(summed.schema), len(labels), by_text, hashed)
    return rows.groupBy(chunk).cogroup(weights.groupBy("_of")).applyInArrow(added, summed.schema)


def free_names(taken: Sequence[str], *names: str) -> list[str]:
    """The names, with as many underscores in front as it takes for none to be among those taken."""
    held, front = {c.lower() for c in taken}, ""
    while held & {front + n for n in names}:
        front += "_"
    return [front + n for n in names]


def _by_key(model: DataFrame, key: str, labels: list) -> DataFrame:
    """The weights of each key in the order of the labels; repeated entries add up, as in :func:`_block`."""
    label = F.coalesce(F.col("label"), F.raise_error(F.lit("a weight without a label")))
    weight = F.coalesce(F.col("weight").cast("double"), F.lit(float("nan")))
    own = model.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), label.alias("label"), weight.alias("weight"))
    sums = [F.coalesce(F.sum(F.when(F.col("label") == F.lit(x), F.col("weight"))), F.lit(0.0)) for x in labels]
    return own.groupBy("_key").agg(F.array(*sums).alias("_weights"))


def _chunker(split: Splitter, by_text: bool, n_buckets: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        size, words, buckets = 0, [], []

        def numbered(columns: list, asks: list, *keys: list) -> pa.RecordBatch:
            lists = [pa.array(k, t) for k, t in zip(keys, (pa.list_(pa.string()), pa.list_(pa.int64())), strict=True)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([chunk] * len(asks)), pa.array(asks), *lists], names=names)

        def asking() -> pa.RecordBatch:
            distinct = pa.concat_arrays(words).unique().cast(pa.string())
            numbers = np.unique(np.concatenate([np.zeros(0, np.int64), *buckets]))
            row = numbered([pa.nulls(1, f.type) for f in batch.schema], [True], [None], [None])
            lists = [pa.ListArray.from_arrays(np.array([0, len(k)], np.int32), k) for k in (distinct, pa.array(numbers))]
            return pa.RecordBatch.from_arrays([*row.columns[:-2], *lists], names=names)

        for batch in batches:
            for piece in split.pieces(batch):
                own = split.words(piece.column(names.index(split.text)))
                words.extend(own.texts(n) for n in range(1, split.ngrams + 1 if by_text else 2))
                if n_buckets:
                    buckets.append(np.unique(_bucket_runs(own, split.ngrams, n_buckets)[1]))
                size += piece.nbytes
                none = [None] * piece.num_rows
                yield numbered(piece.columns, [False] * piece.num_rows, none, none)
                keys = sum(map(len, words)) + sum(map(len, buckets))
                if size >= CHUNK_BYTES or 8 * keys * split.labels >= 4 * CHUNK_BYTES:
                    yield asking()
                    size, words, buckets, chunk = 0, [], [], chunk + 1
        if words:
            yield asking()

    return run


def _weigher(split: Splitter, schema: pa.Schema, n_labels: int, by_text: bool, n_buckets: int):
    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        weights = found["_weights"].combine_chunks().flatten().to_numpy().reshape(-1, n_labels)
        words, buckets = found["_word"].combine_chunks(), found["_run"].combine_chunks()
        of_word, of_run = (x.is_valid().to_numpy(zero_copy_only=False) for x in (words, buckets))
        steps = [(_find_words, (WordTable.of(words.drop_null()), weights[of_word], by_text))]
        if n_buckets:
            steps.append((_find_buckets, _bucket_table(buckets.drop_null(), weights[of_run], n_buckets, True)))
        pieces = (p for batch in rows.select(schema.names).to_batches() for p in split.pieces(batch))
        done = [_added(p, split, steps) for p in pieces]
        return pa.Table.from_batches(done).cast(schema) if done else schema.empty_table()

    return run


class Splitter:
    """Cuts the texts of a batch into words."""

    def __init__(self, text: str, end: bytes | None, ngrams: int, labels: int):
        self.text, self.end, self.ngrams, self.labels = text, end, ngrams, labels

    def pieces(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """The rows of a batch in pieces with texts of some bytes; a row is never cut."""
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.names.index(self.text))), 0)
        ends = np.append(0, np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64))
        most = max(1, CHUNK_BYTES * batch.num_rows // max(1, batch.nbytes))
        text_bytes = PIECE_BYTES * PIECE_LABELS // max(PIECE_LABELS, self.labels)
        at = 0
        while at < batch.num_rows:
            fit = int(np.searchsorted(ends, ends[at] + text_bytes, "right")) - 1
            to = min(max(at + 1, fit), at + most, batch.num_rows)
            yield batch.slice(at, to - at)
            at = to

    def words(self, column: pa.Array) -> Words:
        content, offsets = text_bytes(column)
        solid = np.ones(256, bool)
        solid[list(WORD_END)] = False
        starts, ends, rows = runs(solid[content], offsets)
        if self.end is not None:
            # The end token stands behind the words of each text.
            content = np.concatenate([content, np.frombuffer(self.end, np.uint8)])
            n, own = len(column), np.arange(len(column))
            order = np.argsort(np.concatenate([rows, own]), kind="stable")
            starts = np.concatenate([starts, np.full(n, len(content) - len(self.end))])[order]
            ends = np.concatenate([ends, np.full(n, len(content))])[order]
            rows = np.concatenate([rows, own])[order]
        return Words(content, starts, ends, rows, len(column))


class Words:
    """Words of a batch: numbers that are equal for equal words, and the distinct words."""

    def __init__(self, content: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n_rows: int):
        self.rows, self.n_rows = rows, n_rows
        self.codes, self.content, self.offsets = distinct_words(content, starts, ends)

    def texts(self, n: int) -> pa.Array:
        """The distinct runs of ``n`` words."""
        own = self if n == 1 else self.joined(n)
        buffers = [None, pa.py_buffer(np.ascontiguousarray(own.offsets)), pa.py_buffer(np.ascontiguousarray(own.content))]
        return pa.Array.from_buffers(pa.large_string(), len(own.offsets) - 1, buffers)

    def joined(self, n: int) -> Words:
        """Runs of ``n`` words of one text, joined by blanks."""
        count = max(0, len(self.codes) - n + 1)
        whole = np.flatnonzero(self.rows[:count] == self.rows[n - 1 :]) if count else np.zeros(0, np.int64)
        codes = self.codes[whole[:, None] + np.arange(n)].ravel()
        # Each word with a blank behind it, so that a run's words and blanks lie next to each other.
        spaced, cuts = gathered(np.append(self.content, np.uint8(32)), *self._spaced(codes))
        return Words(spaced, cuts[:-1:2][::n], cuts[1::2][n - 1 :: n], self.rows[whole], self.n_rows)

    def _spaced(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends = np.empty(2 * len(codes), np.int64), np.empty(2 * len(codes), np.int64)
        starts[::2], ends[::2] = self.offsets[codes], self.offsets[codes + 1]
        starts[1::2], ends[1::2] = len(self.content), len(self.content) + 1
        return starts, ends


def _find_words(words: Words, ngrams: int, table: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Rows and weights of the words, and of the runs if they are known by their text, that the block has; all count."""
    known, weights, by_text = table
    rows, places = [], []
    for n in range(1, ngrams + 1 if by_text else 2):
        own = words if n == 1 else words.joined(n)
        found = known.find(own.content, own.offsets)[own.codes] if len(own.codes) else np.zeros(0, np.int64)
        rows.append(own.rows[found >= 0])
        places.append(found[found >= 0])
    return np.concatenate(rows), np.concatenate(places), weights, True


def _bucket_runs(words: Words, ngrams: int, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and buckets of the runs; labels are no part of them."""
    lengths = np.diff(words.offsets)
    marked = np.zeros(len(lengths), bool)
    for i in np.flatnonzero(lengths >= len(LABEL_MARK)).tolist():
        marked[i] = words.content[words.offsets[i] : words.offsets[i] + len(LABEL_MARK)].tobytes() == LABEL_MARK
    keep = ~marked[words.codes] if len(words.codes) else np.zeros(0, bool)
    hashes = fnv_hashes(words.content, words.offsets)[words.codes[keep]] if keep.any() else np.zeros(0, np.int32)
    return run_buckets(hashes, words.rows[keep], ngrams, n_buckets)


def _find_buckets(words: Words, ngrams: int, table: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Rows and weights of the runs whose buckets the block has; the first block has all runs, and counts them."""
    numbers, weights, n_buckets, first = table
    rows, found = _bucket_runs(words, ngrams, n_buckets)
    place = np.minimum(np.searchsorted(numbers, found), max(0, len(numbers) - 1))
    has = numbers[place] == found if len(numbers) else np.zeros(len(found), bool)
    if first:
        # The run counts whether its bucket has weights in this block, in another one, or nowhere.
        place = np.where(has, place, len(numbers))
        return rows, place, np.vstack([weights, np.zeros(weights.shape[1])]), True
    return rows[has], place[has], weights, False


def _adder(sent, split: Splitter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = opened(sent)
        for batch in batches:
            for piece in split.pieces(batch):
                yield _added(piece, split, steps)

    return run


def _added(batch: pa.RecordBatch, split: Splitter, steps: list) -> pa.RecordBatch:
    """The rows with what the steps find added to their counts and sums."""
    names = batch.schema.names
    count, total = names.index("_n"), names.index("_sums")
    n_rows = batch.num_rows
    many = batch.column(count).to_numpy().copy()
    sums = batch.column(total).flatten().to_numpy().reshape(n_rows, -1).copy()
    words = split.words(batch.column(names.index(split.text)))
    for find, table in steps:
        row, place, weights, counted = find(words, split.ngrams, table)
        if counted:
            many += np.bincount(row, minlength=n_rows)
        for label in range(weights.shape[1]):
            sums[:, label] += np.bincount(row, weights[place, label], minlength=n_rows)
    columns = list(batch.columns)
    columns[count] = pa.array(many)
    columns[total] = pa.ListArray.from_arrays(np.arange(0, sums.size + 1, sums.shape[1], dtype=np.int32), sums.ravel())
    return pa.RecordBatch.from_arrays(columns, names=names)


def add_confidence(
    docs: DataFrame, model: DataFrame, text: str = "text", **options
) -> DataFrame:
    """Every row with ``label`` and ``confidence`` of its best label; both null without a known token.

    Columns of these names are replaced. Equal probabilities go to the greater label. ``options`` are those of
    :func:`add_sums`.
    """
    base = docs.drop("label", "confidence")
    summed, labels = add_sums(base, model, text, **options)
    names = F.from_json(F.lit(json.dumps([str(x) for x in labels])), "array<string>")
    logits = F.transform("_sums", lambda s, i: F.struct((s / F.col("_n")).alias("z"), F.get(names, i).alias("label")))
    top = F.array_max(logits)
    scored = summed.withColumn("_top", F.when(F.col("_n") > 0, top))
    total = F.aggregate("_sums", F.lit(0.0), lambda acc, s: acc + F.exp(s / F.col("_n") - F.col("_top")["z"]))
    number = label_number(F.col("_top")["label"])
    return scored.select(
        *[F.col(f"`{c}`") for c in base.columns],
        number.alias("label"),
        F.when(number.isNotNull(), F.lit(1.0) / total).alias("confidence"),
    )


def classify_text(
    docs: DataFrame, model: DataFrame, ids: Sequence[str], text: str = "text", **options
) -> DataFrame:
    """``label`` and ``confidence`` (softmax of the mean weights) of the best label per document.

    Documents without text or without any known token get no row here; they still count in the retention figures,
    which start from the raw lines. ``options`` are those of :func:`add_sums`: ``end``, a token put behind every text,
    ``ngrams``, the longest run of words that is looked up, ``buckets`` for models that know runs by their hash.
    """
    narrow = docs.select(*ids, F.col(text).alias("_text"))
    scored = add_confidence(narrow, model, "_text", **options)
    return scored.where(F.col("label").isNotNull()).drop("_text")


def keep_positive(df: DataFrame, label: int = 1, min_confidence: float = 0.0) -> DataFrame:
    """Rows of the wanted label; ``score`` is the confidence rounded to four digits."""
    kept = df.where((F.col("label") == label) & (F.col("confidence") >= min_confidence))
    return kept.withColumn("score", round_even("confidence", 4)).drop("label", "confidence")


def filter_documents(
    docs: DataFrame, model: DataFrame, text: str = "text", label: int = 1, min_confidence: float = 0.0
) -> DataFrame:
    """The documents that pass, with their ``score`` (an existing one is replaced); nothing is shuffled."""
    return keep_positive(add_confidence(docs.drop("score"), model, text), label, min_confidence)


def retention_by_file(
    lines: DataFrame,
    retained: Column | str = "retained",
    source: str = "source_file",
    files: DataFrame | None = None,
) -> DataFrame:
    """Lines, retained lines and rate per file.

    ``lines`` holds every non-blank line, malformed ones and those without text included. ``files`` lists the file
    names, so that a file without any line is reported too.
    """
    counted = lines.groupBy(source).agg(
        F.count("*").alias("total"), F.count_if(F.coalesce(_col(retained), F.lit(False))).alias("retained")
    )
    if files is not None:
        zero = F.lit(0).cast("bigint")
        empty = files.select(F.col(source), zero.alias("total"), zero.alias("retained"))
        counted = counted.unionByName(empty).groupBy(source).agg(F.sum("total").alias("total"), F.sum("retained").alias("retained"))
    return counted.withColumn("retention_rate", percent(F.col("retained"), F.col("total")))


def retention_summary(per_file: DataFrame, failed: DataFrame | None = None, source: str = "source_file") -> DataFrame:
    """One row over all files; ``failed`` names those that could not be read. The rate is rounded to two digits."""
    done = per_file.select("total", "retained", F.lit(1).alias("ok"))
    if failed is not None:
        none = F.lit(None).cast("bigint")
        done = done.unionByName(failed.select(none.alias("total"), none.alias("retained"), F.lit(0).alias("ok")))
    sums = done.agg(
        F.count("*").alias("total_files"),
        F.coalesce(F.sum("ok"), F.lit(0)).alias("successful_files"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("total_lines"),
        F.coalesce(F.sum("retained"), F.lit(0)).alias("retained_lines"),
    )
    return sums.select(
        "total_files",
        "successful_files",
        (F.col("total_files") - F.col("successful_files")).alias("failed_files"),
        "total_lines",
        "retained_lines",
        round_even(percent(F.col("retained_lines"), F.col("total_lines")), 2).alias("overall_retention_rate"),
    )


def cumulative_retention(per_file: DataFrame, source: str = "source_file") -> DataFrame:
    """Running lines, retained lines and rate, in the order of the file names."""
    sums = {"processed": "total", "kept": "retained"}
    running = with_running(per_file, [], [source], sums)
    return running.select(
        source, "processed", "kept", percent(F.col("kept"), F.col("processed")).alias("cumulative_rate")
    )


def filter_report(per_file: DataFrame, failed: DataFrame | None = None, source: str = "source_file") -> DataFrame:
    """Flat report: a ``summary`` row, a ``file`` row per file and a ``failed`` row per unreadable file.

    Rows instead of one nested value, so that it grows as a table.
    """
    summary = retention_summary(per_file, failed, source).select(
        F.lit("summary").alias("section"),
        F.lit(None).cast("string").alias("filename"),
        F.col("total_lines").alias("total"),
        F.col("retained_lines").alias("retained"),
        F.col("overall_retention_rate").alias("retention_rate"),
        F.col("total_files").alias("files"),
    )
    details = per_file.select(
        F.lit("file").alias("section"),
        F.col(source).alias("filename"),
        "total",
        "retained",
        "retention_rate",
        F.lit(1).cast("bigint").alias("files"),
    )
    report = summary.unionByName(details)
    if failed is None:
        return report
    names = failed.select(F.lit("failed").alias("section"), F.col(source).alias("filename"))
    return report.unionByName(names, allowMissingColumns=True)


def write_filter_report(per_file: DataFrame, path: str, failed: DataFrame | None = None) -> None:
    """``summary`` as one JSON row, ``file_details`` and ``failed_files`` as JSON lines next to it."""
    retention_summary(per_file, failed).write.mode("overwrite").json(f"{path}/summary")
    per_file.write.mode("overwrite").json(f"{path}/file_details")
    if failed is not None:
        failed.write.mode("overwrite").json(f"{path}/failed_files")
