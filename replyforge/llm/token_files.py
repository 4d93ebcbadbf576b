"""Token ids as flat unsigned integer files with 64-bit document offsets.

``write`` sorts the documents by key over range partitions. Each partition writes one shard below a folder all
executors share:

* ``<shard>.ids``: the ids of its documents one after another, unsigned and little-endian, 16 bits wide when the
  vocabulary allows, else 32;
* ``<shard>.offsets``: unsigned 64-bit, where each document starts in the shard, and the end of the last;
* ``<shard>.keys``: signed 64-bit, the keys.

A shard's files carry the name of the attempt that wrote them, and only the names that a finished task hands back
enter the manifest, so an attempt that was lost leaves nothing but unused files. The manifest, a small table of one row
per shard, holds each shard's base: the prefix sum of the shards before it. ``read`` maps the files into memory.

Null and empty texts hold the end id alone. Keys have to be long integers; rows that repeat a key stand next to each
other, ordered by text. Null keys are stored as the smallest number, stand first and are read back as null. Texts of any length are encoded in parts at spaces. Columns other than
key and text are not read. An empty table gives an empty manifest and reads back as an empty table.
"""

from __future__ import annotations

import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from replyforge.llm.batches import per_process
from replyforge.llm.presplit import PieceTable, cut
from replyforge.sources.storage import materialize, new_path

MANIFEST = "shard int, stem string, width int, n_docs long, n_ids long"
NULL_KEY = -(1 << 63)
UNSURE_TEXT = re.compile("[^\\u0000-\\u024f\\u2010-\\u2027\\u2030-\\u205e\\u20ac]")


class Encoder:
    """The library's ids of whole texts; each distinct piece is encoded once per worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends_word[number] = token.endswith("</w>")
        self.seen = PieceTable(400_000)

    def ready(self, text: str) -> str:
        """The normalised text. Below U+0250 normalisation is lower case; white space only separates pieces."""
        return self.tokenizer.normalizer.normalize_str(text) if UNSURE_TEXT.search(text) else text.lower()

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def values(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, many in one call: no piece holds white space, and only its last id is one that ends a word."""
        kind, found = f"<u{self.width}", []
        for low in range(0, len(pieces), 4096):
            part = pieces[low : low + 4096]
            plain = [p for p in part if p not in self.specials]
            ids = np.array(
                self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, np.int64
            )
            ends = np.flatnonzero(self.ends_word[ids]) + 1 if len(ids) else ids
            if len(ends) == len(plain) == len(part):
                content, size = ids.astype(kind).tobytes(), self.width
                cuts = [0, *(ends * size).tolist()]
                found.extend([content[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
            else:
                encoded = self.tokenizer.encode_batch(part, add_special_tokens=False)
                found.extend([np.array(e.ids, kind).tobytes() for e in encoded])
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian numbers of ``width`` bytes."""
        found: list[list[bytes]] = [[] for _ in texts]
        for pieces in cut(texts, False, self.spans, self.specials, self.ready):
            slots, values = self.seen.slots_of(pieces, self.values), self.seen.values
            rows = pieces.rows
            firsts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else rows
            for low, high in zip(firsts.tolist(), [*firsts[1:].tolist(), len(rows)], strict=True) if len(rows) else ():
                found[rows[low]].append(b"".join([values[s] for s in slots[low:high].tolist()]))
        return [b"".join(f) for f in found]


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder named by a path or an URI of any scheme pyarrow knows."""
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", folder))
    return fs.LocalFileSystem(), folder


def write(
    docs: DataFrame, path: str, folder: str, end_id: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write the shards and answer the manifest with ``base``, the ids in all shards before."""

    def run(batches):
        encoder = per_process(("encoder", path), lambda: Encoder(path))
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        files, place = open_folder(folder)
        shard = TaskContext.get().partitionId()
        stem = f"{shard:06d}-{uuid.uuid4().hex}"
        offsets, keys, total = [0], [], 0
        out = None
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                if out is None:
                    files.create_dir(place, recursive=True)
                    out = files.open_output_stream(f"{place}/{stem}.ids")
                part = batch.slice(low, 512)
                keys.append(np.asarray(part.column(0).to_numpy(zero_copy_only=False), "<i8").tobytes())
                for ids in encoder.encode(part.column(1).to_pylist()):
                    out.write(ids)
                    out.write(end)
                    total += len(ids) // encoder.width + 1
                    offsets.append(total)
        if out is None:
            return
        out.close()
        for name, content in (("offsets", np.array(offsets, "<u8").tobytes()), ("keys", b"".join(keys))):
            with files.open_output_stream(f"{place}/{stem}.{name}") as file:
                file.write(content)
        row = [[shard], [stem], [encoder.width], [len(offsets) - 1], [total]]
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["shard", "stem", "width", "n_docs", "n_ids"])

    ordered = (
        docs.select(
            F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NULL_KEY)).alias("key"),
            F.col(f"`{text}`").alias("text"),
        )
        .repartitionByRange("key")
        .sortWithinPartitions("key", "text")
    )
    shards = materialize(ordered.mapInArrow(run, MANIFEST), "token-shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def mapped(files: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file as an array: mapped into memory where it is local, else read."""
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if files.get_file_info(path).size else np.zeros(0, kind)
    with files.open_input_file(path) as file:
        return np.frombuffer(file.readall(), kind)


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document, from the files: key, ``start``, ``n_tokens`` and ``ids_crc32``."""

    def run(batches):
        files, place = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                stem = f"{place}/{row['stem']}"
                ids = mapped(files, f"{stem}.ids", f"<u{row['width']}")
                offsets = mapped(files, f"{stem}.offsets", "<u8").astype(np.int64)
                keys = mapped(files, f"{stem}.keys", "<i8")
                sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                columns = [np.array(keys), offsets[:-1] + row["base"], np.diff(offsets), np.array(sums, np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "start", "n_tokens", "ids_crc32"])

    found = manifest.repartition(F.col("shard")).mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long")
    return found.withColumn("key", F.when(F.col("key") != NULL_KEY, F.col("key")))


def folder_for(spark: SparkSession) -> str:
    return new_path(spark, "token-files")
