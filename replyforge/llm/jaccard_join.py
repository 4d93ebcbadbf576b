"""N-gram Jaccard join: prefix filters under several global token orders, then exact verification.

A document's tokens are its distinct shingles of ``size`` lower-case words (fewer words: one shingle of all). Two
documents link when ``100 * shared >= percent * union``. Both numbers are arguments; ``WORDS`` is the default size.

1. Documents with equal sets are one class, found by size and two 64-bit sums over the set; classes are what is joined.
2. All classes' tokens are exchanged once, packed, by token bucket. There a token's document frequency is counted.
   Tokens of one class alone take no further part, except by their number.
3. Back at the class: of two linked sets each shares at least ``ceil(percent * n / 100)`` tokens with the other, so
   under any global order they have a token in common among their first ``n - ceil(percent * n / 100) + 1``, the
   prefix. All orders put rare tokens first; they differ in the frequency's grain and in the order among equals. A
   class whose prefix holds only tokens of its own links with nothing and is done. For most texts this is the end.
4. Classes that share a prefix token under the first order are put into one block (a star per token, then connected
   components), so that each class travels to one place. Blocks above ``TILE`` classes are worked on in tiles.
5. In a tile a pair is verified when all orders' prefixes meet and the sizes allow a link, by counting shared tokens
   exactly. Pairs already connected through others are skipped; every other pair of a block is looked at in some tile.

Tokens are 64-bit hashes, of which the bucket's number and 48 bits are kept.

Null texts and texts without words have no tokens and link with nothing. Repeated rows count as copies; rows that
repeat a key form a link through it. Rows with a null key get a null component, and link nothing. Very long texts are one set like any other. An empty table gives an empty table.
Columns other than key and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyforge.llm import packed
from replyforge.llm.batches import mixed, utf8
from replyforge.llm.components import components
from replyforge.llm.words import shingles, words
from replyforge.sources.storage import materialize

WORDS = 4
#: Tokens of a bucket, of a task's packed rows, and classes in a tile; they bound the memory of a task.
BUCKET_TOKENS = 1 << 21
FLUSH_TOKENS = 1 << 20
TILE = 1000
#: Classes of a part that are compared first with other parts.
HEADS = 8
SEEDS = (0, 0x3C6EF372FE94F82B, 0x1B873593CC9E2D51)
MASK48 = np.uint64((1 << 48) - 1)


def token_sets(column: pa.Array, size: int):
    """The sorted distinct tokens of every text."""
    data, offsets = utf8(column)
    for _, n, rows, _, _, hashes, _ in words(data, offsets, solid=True):
        found, places = shingles(hashes, rows, size)
        cuts = np.searchsorted(rows[places], np.arange(n + 1))
        bounds = np.searchsorted(rows, np.arange(n + 1))
        for i in range(n):
            own = found[cuts[i] : cuts[i + 1]]
            if not len(own) and bounds[i] < bounds[i + 1]:
                own, _ = shingles(hashes[bounds[i] : bounds[i + 1]], rows[bounds[i] : bounds[i + 1]], int(bounds[i + 1] - bounds[i]))
            yield np.unique(own)


def signature(tokens: np.ndarray) -> tuple[int, int]:
    return int(mixed(tokens).sum().astype(np.int64)), int(mixed(tokens ^ np.uint64(SEEDS[1])).sum().astype(np.int64))


def prefix_size(n, percent: int):
    return n - -(-percent * n // 100) + 1


def _signed(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [(len(t), *signature(t)) for t in token_sets(batch.column(1), size)]
            columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["key", "n", "s1", "s2"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n long, s1 long, s2 long")


def _postings(docs: DataFrame, text: str, n_buckets: int, size: int) -> DataFrame:
    """Packed tokens by token bucket; of equal sets in a task only the first is sent."""

    def run(batches):
        sets, names, sizes, seen = [], [], [], set()

        def flush():
            tokens = np.concatenate(sets)
            bucket = ((tokens >> np.uint64(44)) * np.uint64(n_buckets) >> np.uint64(20)).astype(np.int64)
            lengths = np.array([len(s) for s in sets])
            owner = np.repeat(np.arange(len(sets)), lengths)
            content = (tokens & MASK48).view(np.uint8).reshape(-1, 8)[:, :6]
            packed_tokens = packed.split(bucket, {"tokens": content}, n_buckets)
            # One entry for each class in a bucket, with the number of its tokens there.
            place = np.sort(bucket * len(sets) + owner)
            fresh = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            counts = np.diff(np.append(fresh, len(place))).astype(np.int32)
            who, where = place[fresh] % len(sets), place[fresh] // len(sets)
            heads = packed.split(where, {"names": np.array(names, np.int64)[who], "sizes": np.array(sizes, np.int32)[who], "counts": counts}, n_buckets)
            yield pa.RecordBatch.from_arrays([*heads.columns, packed_tokens.column(1)], [*heads.schema.names, "tokens"])

        total = 0
        for batch in batches:
            for tokens in token_sets(batch.column(0), size):
                if not len(tokens):
                    continue
                mark = signature(tokens)
                if mark in seen:
                    continue
                seen.add(mark)
                sets.append(tokens), names.append(mark[0]), sizes.append(len(tokens))
                total += len(tokens)
                if total >= FLUSH_TOKENS:
                    yield from flush()
                    sets, names, sizes, total = [], [], [], 0
        if sets:
            yield from flush()

    return docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, packed.schema(["names", "sizes", "counts", "tokens"]))


def _shared(postings: DataFrame, n_buckets: int) -> DataFrame:
    """Tokens that several classes have, with their frequency, packed by class bucket."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        names, sizes = packed.gather(table, "names", np.int64), packed.gather(table, "sizes", np.int32)
        counts, raw = packed.gather(table, "counts", np.int32), packed.gather(table, "tokens", np.uint8, 6)
        tokens = np.zeros((len(raw), 8), np.uint8)
        tokens[:, :6] = raw
        tokens = tokens.view(np.uint64).ravel() | np.uint64((bucket & 0xFFFF) << 48)
        # A class may come from several tasks; its tokens count once.
        first = np.zeros(len(names), bool)
        first[np.unique(names, return_index=True)[1]] = True
        owner = np.repeat(np.arange(len(names)), counts)
        keep = first[owner]
        owner, tokens = owner[keep], tokens[keep]
        order = np.argsort(tokens, kind="stable")
        ordered = tokens[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
        frequency = np.diff(np.append(starts, len(ordered)))
        each = np.repeat(frequency, frequency)
        order, ordered, each = order[each > 1], ordered[each > 1], each[each > 1]
        who = names[owner[order]]
        target = (mixed(who.view(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
        columns = {"names": who, "sizes": sizes[owner[order]], "tokens": ordered, "df": each.astype(np.uint32)}
        return pa.Table.from_batches([packed.split(target, columns, n_buckets)])

    return postings.groupBy("bucket").applyInArrow(run, packed.schema(["names", "sizes", "tokens", "df"]))


def prefixes(tokens: np.ndarray, df: np.ndarray, length: int) -> list[np.ndarray]:
    """The first ``length`` tokens under each order."""
    level = np.log2(df).astype(np.int64)
    found = []
    for i, seed in enumerate(SEEDS):
        order = np.lexsort((mixed(tokens ^ np.uint64(seed)), level if i else df))
        found.append(tokens[order[:length]])
    return found


def _near(shared: DataFrame, percent: int) -> DataFrame:
    """Classes whose prefix holds a token of another class: name, size, shared tokens, and the prefixes."""

    def run(table: pa.Table) -> pa.Table:
        names, sizes = packed.gather(table, "names", np.int64), packed.gather(table, "sizes", np.int32)
        tokens, df = packed.gather(table, "tokens", np.uint64), packed.gather(table, "df", np.uint32)
        order = np.argsort(names, kind="stable")
        ordered = names[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        lengths = np.diff(np.append(starts, len(ordered)))
        n = sizes[order[starts]].astype(np.int64)
        alone = n - lengths
        out = {c: [] for c in ("name", "n", "tokens", "first", "second", "third")}
        for i in np.flatnonzero(alone < prefix_size(n, percent)):
            own = order[starts[i] : starts[i] + lengths[i]]
            found = prefixes(tokens[own], df[own], int(prefix_size(int(n[i]), percent) - alone[i]))
            out["name"].append(int(ordered[starts[i]]))
            out["n"].append(int(n[i]))
            out["tokens"].append(np.sort(tokens[own]).tobytes())
            out["first"].append(found[0].view(np.int64))
            out["second"].append(found[1].tobytes())
            out["third"].append(found[2].tobytes())
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

    return shared.groupBy("bucket").applyInArrow(
        run, "name long, n long, tokens binary, first array<long>, second binary, third binary"
    )


def _blocks(near: DataFrame) -> DataFrame:
    """The block of every class that shares a prefix token with another."""
    prefix = near.select("name", F.explode("first").alias("token"))
    hubs = prefix.groupBy("token").agg(F.min("name").alias("hub"), F.max("name").alias("last")).where("hub != last")
    stars = prefix.join(hubs, "token").where("name != hub").select(F.col("hub").alias("a"), F.col("name").alias("b")).distinct()
    return components(stars, "jaccard-blocks").select(F.col("v").alias("name"), F.col("label").alias("block"))


def compare(rows: list[dict], percent: int) -> list[tuple[int, int]]:
    """Links that connect the rows as all their links do; rows of equal ``part`` are known to be connected."""
    rows = sorted(rows, key=lambda r: r["name"])
    sizes = np.array([r["n"] for r in rows])
    tokens = [np.frombuffer(r["tokens"], np.uint64) for r in rows]
    first = [set(r["first"]) for r in rows]
    others = [[set(np.frombuffer(r[c], np.int64).tolist()) for r in rows] for c in ("second", "third")]
    parts = np.unique([r["part"] for r in rows], return_inverse=True)[1]
    found = []

    def test(i: int, j: int) -> None:
        a, b = (i, j) if len(tokens[i]) <= len(tokens[j]) else (j, i)
        # The filters of all orders, then the count.
        if first[a].isdisjoint(first[b]) or any(o[a].isdisjoint(o[b]) for o in others):
            return
        at = np.searchsorted(tokens[b], tokens[a])
        at[at == len(tokens[b])] = 0
        both = int((tokens[b][at] == tokens[a]).sum()) if len(tokens[b]) else 0
        if 100 * both >= percent * (sizes[i] + sizes[j] - both):
            found.append((rows[i]["name"], rows[j]["name"]))
            parts[parts == parts[j]] = parts[i]

    def fits(i: int, open_rows: np.ndarray) -> np.ndarray:
        """Rows of other parts whose size allows a link."""
        other = open_rows[parts[open_rows] != parts[i]]
        small, large = np.minimum(sizes[other], sizes[i]), np.maximum(sizes[other], sizes[i])
        return other[100 * small >= percent * large]

    left = np.arange(len(rows))
    while len(left) > 1:  # stars first: they connect most copies in one step each
        hub = left[0]
        for j in fits(hub, left[1:]):
            if parts[j] != parts[hub]:
                test(hub, j)
        left = left[1:][parts[left[1:]] != parts[hub]]
    largest = np.bincount(parts).argmax()
    everyone = np.arange(len(rows))
    for i in np.flatnonzero(parts != largest):  # then what is still apart, pair by pair
        for j in fits(i, everyone):
            if parts[j] != parts[i]:
                test(i, j)
    return found


def _tiled(near: DataFrame, tiles: DataFrame, percent: int) -> DataFrame:
    """Links found in tiles; ``tiles`` has name, tile and part."""

    def run(table: pa.Table) -> pa.Table:
        links = compare(table.to_pylist(), percent)
        return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return near.join(tiles, "name").groupBy("tile").applyInArrow(run, "a long, b long")


def _links(near: DataFrame, percent: int) -> DataFrame:
    blocks = materialize(_blocks(near), "jaccard-blocks")
    sizes = blocks.groupBy("block").agg(F.count("*").alias("classes"))
    cuts = F.ceil(F.col("classes") / TILE)
    cut = blocks.join(sizes, "block").select("name", "block", F.pmod(F.xxhash64("name"), cuts).alias("cut"), "classes")
    tiles = cut.select("name", F.struct("block", "cut").alias("tile"), F.col("name").alias("part"))
    links = materialize(_tiled(near, tiles, percent), "jaccard-links")
    large = materialize(cut.where(F.col("classes") > TILE), "jaccard-large")
    if large.isEmpty():
        return links
    # What the cuts left apart: first a few classes of each part against those of the other parts ...
    known = _parts(large, links)
    sizes = known.groupBy("block", "part").agg(F.count("*").alias("members"), F.min("name").alias("head"))
    some = F.pmod(F.xxhash64("name", F.lit(2)), F.ceil(F.col("members") / HEADS)) == 0
    per_block = sizes.groupBy("block").agg(F.count("*").alias("n_parts")).where("n_parts > 1")
    heads = known.join(sizes, ["block", "part"]).where((F.col("name") == F.col("head")) | some).join(per_block, "block")
    group = F.pmod(F.xxhash64("part"), F.ceil(F.col("n_parts") * 2 * HEADS / TILE))
    links = materialize(
        links.union(_tiled(near, heads.select("name", F.struct("block", group.alias("group")).alias("tile"), "part"), percent)),
        "jaccard-links",
    )
    # ... then every class outside its block's largest part against every cut of the block. Copies of one text are one
    # part by now; what is left are classes that share rare tokens and do not link.
    known = _parts(large, links)
    largest = (
        known.groupBy("block", "part")
        .agg(F.count("*").alias("members"))
        .groupBy("block")
        .agg(F.max_by("part", F.struct("members", "part")).alias("largest"), F.sum("members").alias("classes"), F.max("members").alias("most"))
        .where("classes > most")
    )
    rest = known.join(largest, "block")
    chunk = F.pmod(F.xxhash64("name", F.lit(1)), F.ceil((F.col("classes") - F.col("most")) / TILE))
    queries = rest.where("part != largest").select("name", "block", "part", chunk.alias("chunk"))
    members = rest.join(queries.select("block", "chunk").distinct(), "block").select("name", "block", "cut", "chunk", "part")
    asked = queries.join(known.select("block", "cut").distinct(), "block").select("name", "block", "cut", "chunk", "part")
    tiles = members.union(asked).distinct().select("name", F.struct("block", "cut", "chunk").alias("tile"), "part")
    return links.union(materialize(_tiled(near, tiles, percent), "jaccard-links"))


def _parts(large: DataFrame, links: DataFrame) -> DataFrame:
    """The classes of large blocks with the part that the links found so far put them in."""
    parts = components(links, "jaccard-parts")
    joined = large.join(parts, large.name == parts.v, "left")
    return materialize(joined.select("name", "block", "cut", F.coalesce("label", "name").alias("part")), "jaccard-parts")


def join_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, size: int = WORDS
) -> DataFrame:
    """One row per input row: key, ``n_shingles`` and ``component_id``, the smallest key reachable by links."""
    signed = materialize(_signed(docs, key, text, size), "jaccard-sets")
    classes = materialize(
        signed.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("key").alias("least"), F.max("key").alias("last")),
        "jaccard-classes",
    )
    total = classes.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(64, -(-total // BUCKET_TOKENS))
    shared = _shared(_postings(docs, text, n_buckets, size), n_buckets)
    near = materialize(_near(shared, percent), "jaccard-near")
    names = classes.select("s1", F.col("least").alias("key"))
    links = _links(near, percent)
    ends = links.join(names.withColumnsRenamed({"s1": "a", "key": "ka"}), "a").join(
        names.withColumnsRenamed({"s1": "b", "key": "kb"}), "b"
    )
    # A class's copies hang on its smallest key; keys that repeat are one vertex.
    copies = signed.join(classes.where("least != last"), ["n", "s1", "s2"]).where("key != least")
    edges = ends.select(F.col("ka").alias("a"), F.col("kb").alias("b")).union(
        copies.select(F.col("least").alias("a"), F.col("key").alias("b"))
    )
    found = components(edges, "jaccard-components")
    return signed.join(found, signed.key == found.v, "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("label", "key").alias("component_id")
    )


def deduplicate(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, size: int = WORDS
) -> DataFrame:
    """The rows of ``docs`` with the smallest key of each component; rows with a null key stay.

    Of rows that repeat such a key, one stays for each text; different texts under one key are all kept.
    """
    found = join_components(docs, key, text, percent, size)
    gone = found.where(F.col("component_id") != F.col(key)).select(F.col(key).alias("__gone")).distinct()
    left = docs.join(gone, docs[key].eqNullSafe(gone["__gone"]), "left_anti")
    kept = found.where(F.col("component_id") == F.col(key)).groupBy(F.col(key).alias("__kept")).count()
    repeated = materialize(kept.where("count > 1").select("__kept"), "jaccard-repeated")
    if repeated.isEmpty():
        return left
    several = docs[key] == repeated["__kept"]
    return left.join(repeated, several, "left_anti").unionAll(left.join(repeated, several, "left_semi").dropDuplicates([key, text]))
