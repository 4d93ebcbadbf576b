"""BPE encoding by a deterministic tokenization automaton, and decoding by its arc labels.

Arcs are tokens, and the state reached depends on the last token alone. The automaton starts with every byte token
allowed after every other. Each merge ``(u, v) -> c``, in rank order, puts in one gadget:

* the arc ``v`` leaves the state behind ``u``, because ``u v`` is merged from now on;
* an arc ``c`` is added wherever an arc ``u`` leads off, once the arc above is gone;
* it leads to a new state with the arcs that the state behind ``v`` had before the gadget.

So a state is the one it was copied from plus the arcs taken away later, and whether an arc is there follows from the
gadgets on the two tokens' edges. ``Automaton.arc`` looks a transition up in the table of those already worked out.
The accepted token sequence of a word is unique, and so is that of each of its prefixes; encoding goes through the
word once and keeps the last token of every prefix.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyforge.llm.batches import per_process
from replyforge.llm.presplit import PieceTable, cut
from replyforge.llm.token_count import piece_cutter
from replyforge.llm.vocabulary import Vocabulary, read_vocabulary


@dataclass
class Automaton:
    born: dict[int, int]  # gadget that made the token's arcs; 0 for bytes
    left: dict[int, int]
    right: dict[int, int]
    removed: dict[int, int]  # arc -> gadget that took it away
    tokens: dict[bytes, int]
    longest: int
    table: dict[int, bool]

    def arc_after(self, state: int, token: int, gadget: int) -> bool:
        """Whether the arc is there once the first ``gadget`` gadgets are in place."""
        while True:
            if self.removed.get(state << 20 | token, gadget + 1) <= gadget:
                return False
            old, new = self.born[state], self.born[token]
            if not old and not new:
                return True
            if new >= old:  # the arc was put where its left part's arc was
                token, gadget = self.left[token], new
            else:  # the state is a copy of the one behind its right part
                state, gadget = self.right[state], old - 1

    def arc(self, state: int, token: int) -> bool:
        place = state << 20 | token
        known = self.table.get(place)
        if known is None:
            if len(self.table) > 2_000_000:
                self.table.clear()
            known = self.table[place] = self.arc_after(state, token, len(self.removed) + 1)
        return known

    def encode(self, word: bytes) -> list[int]:
        """The one accepted sequence of arcs for the bytes of a pre-split word."""
        n, tokens, longest, arc = len(word), self.tokens, self.longest, self.arc
        last, came = [-1] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - longest), end):
                token = tokens.get(word[start:end])
                if token is not None and (start == 0 or arc(last[start], token)):
                    last[end], came[end] = token, start
                    break
        path, at = [], n
        while at:
            path.append(last[at])
            at = came[at]
        path.reverse()
        return path


def build(vocabulary: Vocabulary) -> Automaton:
    """Put in the gadgets of all merges, in rank order."""
    machine = Automaton({i: 0 for i in vocabulary.byte_ids}, {}, {}, {}, {}, 1, {})
    for pair, (_, made) in sorted(vocabulary.merges.items(), key=lambda item: item[1][0]):
        u, v, gadget = pair >> 20, pair & 0xFFFFF, len(machine.removed) + 1
        if made not in machine.born and u in machine.born and v in machine.born and machine.arc_after(u, v, gadget - 1):
            machine.born[made], machine.left[made], machine.right[made] = gadget, u, v
        machine.removed[pair] = gadget
    machine.tokens = {vocabulary.labels[i]: i for i in machine.born}
    machine.longest = max(map(len, machine.tokens))
    return machine


#: What a piece becomes: the arcs it takes, their numbers as text, and their labels put together.
Coded = tuple[list[int], str, bytes]


class Codec:
    """Encodes and decodes texts; equal pieces are encoded once per worker."""

    def __init__(self, path: str, pieces: int = 600_000):
        self.vocabulary = read_vocabulary(path)
        self.machine = build(self.vocabulary)
        self.library = piece_cutter(path)
        self.seen = PieceTable(pieces)

    def forget(self) -> None:
        """Let go of what was worked out."""
        self.seen.clear()
        self.machine.table.clear()

    def values(self, pieces: list[str]) -> list[Coded]:
        specials, labels, encode = self.vocabulary.specials, self.vocabulary.labels, self.machine.encode
        found = []
        for piece in pieces:
            path = [specials[piece]] if piece in specials else encode(piece.encode("utf-8"))
            found.append((path, ",".join(map(str, path)), b"".join([labels[i] for i in path])))
        return found

    def encode(self, texts: list[str | None]) -> list[list[Coded]]:
        """The coded pieces of each text, in order."""
        found: list[list[Coded]] = [[] for _ in texts]
        for pieces in cut(texts, True, self.library, tuple(self.vocabulary.specials)):
            slots, values = self.seen.slots_of(pieces, self.values), self.seen.values
            for row, low, high in runs(pieces.rows):
                found[row].extend([values[s] for s in slots[low:high].tolist()])
        return found


def ids_of(coded: list[Coded]) -> list[int]:
    return [i for path, _, _ in coded for i in path]


def decoded(coded: list[Coded]) -> bytes:
    """The bytes on the arcs, with what is no UTF-8 replaced."""
    whole = b"".join([label for _, _, label in coded])
    return whole.decode("utf-8", "replace").encode("utf-8")


def sha256(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def runs(rows: np.ndarray):
    """(row, first, end) of each run of equal values."""
    if len(rows):
        firsts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        for low, high in zip(firsts.tolist(), [*firsts[1:].tolist(), len(rows)], strict=True):
            yield int(rows[low]), low, high


OUTPUTS = {
    "ids": "array<int>",
    "n_tokens": "long",
    "ids_sha256": "string",
    "decoded": "string",
    "decoded_sha256": "string",
}


def encode_decode(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    outputs: tuple[str, ...] = ("ids", "decoded"),
    pieces: int = 600_000,
    release: bool = False,
) -> DataFrame:
    """Key and the asked outputs of every row: ids, their number and digest, the decoded text and its digest.

    Null and empty texts have no ids and decode to the empty text; ids are those of the library without added special
    tokens, special strings inside a text included. Rows are independent; an empty table gives an empty table, and
    columns other than key and text are not read. A worker remembers up to about ``pieces`` pieces, and with ``release``
    none beyond a task, which costs time and leaves memory to other steps of a job. ``path`` is the vocabulary file, there on every worker.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = [n for n in OUTPUTS if n in outputs]

    def run(batches):
        codec = per_process(("codec", path, pieces), lambda: Codec(path, pieces))
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.column(1).slice(low, 256).to_pylist()
                coded = codec.encode(part)
                made = {
                    "ids": lambda: pa.array([ids_of(c) for c in coded], pa.list_(pa.int32())),
                    "n_tokens": lambda: pa.array([sum([len(p) for p, _, _ in c]) for c in coded], pa.int64()),
                    "ids_sha256": lambda: pa.array([sha256(",".join([t for _, t, _ in c]).encode()) for c in coded]),
                    "decoded": lambda: pa.array([decoded(c).decode("utf-8") for c in coded]),
                    "decoded_sha256": lambda: pa.array([sha256(decoded(c)) for c in coded]),
                }
                columns = [batch.column(0).slice(low, 256), *[made[n]() for n in names]]
                yield pa.RecordBatch.from_arrays(columns, ["key", *names])
        if release:
            codec.forget()

    return (
        docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
        .mapInArrow(run, ", ".join([f"key {kind}", *[f"{n} {OUTPUTS[n]}" for n in names]]))
        .withColumnRenamed("key", key)
    )
