"""Image parts of a prompt as message items."""

from __future__ import annotations

from base64 import b64encode
from collections.abc import Iterator
from hashlib import sha256
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replyforge.functions.text import _col
from replyforge.sources.files import open_folder
from replyforge.sources.storage import materialize, new_path

IMAGE_MARKS = ("<|image|>", "<image> ")
ITEM = "struct<type:string,text:string,image:string,detail:string>"
#: Characters of data URLs in a batch of rows, and of those a worker keeps.
SHOWN_BYTES = 16 << 20
KEPT_BYTES = 64 << 20


def image_path(part: Column | str) -> Column:
    """Path behind an image mark, null for a text part."""
    part = _col(part)
    marked = part.startswith(IMAGE_MARKS[0]) | part.startswith(IMAGE_MARKS[1])
    bare = F.replace(F.replace(part, F.lit(IMAGE_MARKS[0]), F.lit("")), F.lit(IMAGE_MARKS[1]), F.lit(""))
    return F.when(marked, bare)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``content`` of image files."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def store_images(images: DataFrame, store: str) -> DataFrame:
    """Put image contents into a folder under their address and answer ``path`` and ``address``, one row per image.

    The address is the SHA-256 of the content, so equal images are kept once. Tasks write what they have read; contents
    are not exchanged, and a file appears whole or not at all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = open_folder(store)
        for batch in batches:
            found = []
            for content in batch.column("content").to_pylist():
                address = sha256(content).hexdigest()
                folder, draft = f"{place}/{address[:2]}", f"_{uuid4().hex}"
                if files.get_file_info(f"{folder}/{address}").type == fs.FileType.NotFound:
                    files.create_dir(folder, recursive=True)
                    with files.open_output_stream(f"{folder}/{draft}") as out:
                        out.write(content)
                    files.move(f"{folder}/{draft}", f"{folder}/{address}")
                found.append(address)
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], ["path", "address"])

    named = images.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.coalesce("content", F.lit(b"")).alias("content"))
    return materialize(named.mapInArrow(run, "path string, address string"), "images")


def refer_images(df: DataFrame, stored: DataFrame, parts: str = "parts") -> DataFrame:
    """Add ``items``: text parts as text, image parts with their address in place of the image, in order.

    ``stored`` is the answer of :func:`store_images`. A missing image fails the job, as nothing may be left out of a
    prompt unnoticed. Items depend on the part list alone: each distinct list, known by a pair of hashes, is put together
    once, and only its own parts ever meet in one row; what is exchanged is texts and addresses.
    """
    lists = ["_p1", "_p2"]
    keyed = df.withColumns({"_p1": F.xxhash64(parts), "_p2": F.xxhash64(F.lit(1), parts)})
    distinct = keyed.groupBy(*lists).agg(F.first(parts).alias("_parts"))
    spread = distinct.select(*lists, F.posexplode_outer("_parts").alias("_pos", "_part")).withColumn(
        "_path", image_path("_part")
    )
    known = stored.select(F.col("path").alias("_path"), F.col("address").alias("_address"))
    shown = spread.where(F.col("_path").isNotNull()).join(known, ["_path"], "left")
    missing = F.raise_error(F.concat(F.lit("no image "), F.col("_path")))
    address = F.when(F.col("_address").isNull(), missing).otherwise(F.col("_address"))
    image_items = shown.select(*lists, "_pos", _item("image_url", image=address, detail=F.lit("low")).alias("_item"))
    text_items = spread.where(F.col("_path").isNull()).select(
        *lists, "_pos", _item("text", text=F.col("_part")).alias("_item")
    )
    # An empty list keeps its row, with no items.
    ordered = F.array_sort(F.collect_list(F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_item"))))
    built = image_items.unionByName(text_items).groupBy(*lists).agg(
        F.transform(ordered, lambda x: x["_item"]).alias("items")
    )
    return keyed.join(built, lists, "left").select(*df.columns, "items")


def show_images(df: DataFrame, store: str, items: str = "items") -> DataFrame:
    """Items with base64 data URLs where :func:`refer_images` has put addresses.

    A narrow step to stand right in front of the call: the task that makes it reads and encodes the images. Rows go on in
    batches of about ``SHOWN_BYTES``, and a worker keeps the images it has shown last, up to ``KEPT_BYTES``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = open_folder(store)
        kept: dict[str, str] = {}

        def url(address: str) -> str:
            if address not in kept:
                with files.open_input_stream(f"{place}/{address[:2]}/{address}") as handle:
                    content = b64encode(handle.read()).decode()
                while kept and sum(map(len, kept.values())) + len(content) > KEPT_BYTES:
                    kept.pop(next(iter(kept)))
                kept[address] = f"data:image/jpeg;base64,{content}"
            return kept[address]

        for batch in batches:
            at = batch.schema.names.index(items)
            kind, begin, size, shown = batch.schema.field(at).type, 0, 0, []

            def part(end: int) -> pa.RecordBatch:
                columns = [c.slice(begin, end - begin) for c in batch.columns]
                columns[at] = pa.array(shown, kind)
                return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

            for i, row in enumerate(batch.column(at).to_pylist()):
                new = row and [{**x, "image": url(x["image"])} if x["type"] == "image_url" else x for x in row]
                shown.append(new)
                size += sum(len(x["image"] or "") for x in new or ())
                if size > SHOWN_BYTES:
                    yield part(i + 1)
                    begin, size, shown = i + 1, 0, []
            if shown:
                yield part(batch.num_rows)

    return df.mapInArrow(run, df.schema)


def build_multimodal(df: DataFrame, images: DataFrame, parts: str = "parts", store: str | None = None) -> DataFrame:
    """Add ``items``: image parts as base64 data URLs with low detail, the others as text, in order.

    ``images`` has ``path`` and ``content``, one row per path. Images go to ``store`` (by default a new folder below the
    shared one) under their address, items are put together from addresses, and data URLs are made in the last step,
    which is narrow: no image is exchanged.
    """
    store = store or new_path(df.sparkSession, "image-store")
    return show_images(refer_images(df, store_images(images, store), parts), store)


def _item(kind: str, text: Column | None = None, image: Column | None = None, detail: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    pick = lambda c: none if c is None else c
    return F.struct(
        F.lit(kind).alias("type"), pick(text).alias("text"), pick(image).alias("image"), pick(detail).alias("detail")
    )


def image_prompt(prompt: Column | str, images: Column | str | None = None, position: str = "before") -> Column:
    """Items of a prompt with an image list: images before or after the text, or none for another position."""
    text = F.array(_item("text", text=F.replace(_col(prompt), F.lit("<image> "), F.lit(""))))
    if images is None:
        return F.array(_item("text", text=_col(prompt)))
    shown = F.transform(
        F.coalesce(_col(images), F.array().cast("array<string>")),
        lambda i: _item("image", image=F.concat(F.lit("file://"), i)),
    )
    if position == "before":
        return F.concat(shown, text)
    return F.concat(text, shown) if position == "after" else text
