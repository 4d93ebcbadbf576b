"""Cutting texts into the pieces that byte-pair merges stay inside, for many texts at once.

Characters become class numbers, and piece starts are found by comparing neighbours. Classes are certain for the
common scripts below U+0250 and usual punctuation; a text with any other character is cut by the tokenizer library's
own pre-tokenizer instead, which gives the same pieces one text at a time. Special strings are cut out first.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from replyforge.functions.spans import distinct_words, gathered, hash_spans
from replyforge.llm.batches import CHUNK, groups, per_process

LETTER, NUMBER, OTHER, SPACE, EDGE, UNSURE = range(6)
#: The characters of the white space property below the limit.
WHITE = "\t\n\x0b\f\r \x85\xa0"
COMMON = [(0, 0x250), (0x2010, 0x2028), (0x2030, 0x205F), (0x20AC, 0x20AD)]


def _classes() -> np.ndarray:
    table = np.full(0x110000, UNSURE, np.uint8)
    for low, high in COMMON:
        for c in range(low, high):
            kind = unicodedata.category(chr(c))[0]
            table[c] = SPACE if chr(c) in WHITE else LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    return table


@dataclass
class Pieces:
    """Pieces of a group of texts: the texts' characters, and each piece's owner row and place."""

    codes: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def word_starts(codes: np.ndarray, kind: np.ndarray, join_space: bool) -> np.ndarray:
    """Where pieces start.

    Runs of letters, of numbers and of other characters are pieces. With ``join_space`` a run takes the space in front
    of it along, and other white space makes pieces of its own: all of a run but its last character, if a word
    follows. Without it each number stands alone. English contractions after an apostrophe are pieces.
    """
    n = len(kind)
    before = np.empty(n, np.uint8)
    before[0], before[1:] = EDGE, kind[:-1]
    blank_before = np.zeros(n, bool)
    blank_before[1:] = (codes[:-1] == 32) & (kind[:-1] == SPACE)
    new_run = kind != before
    solid = new_run & (kind <= OTHER)
    if join_space:
        start = solid & ~blank_before
        after_space = np.flatnonzero(solid & (before == SPACE))
        start[after_space - 1] = True
        start |= new_run & (kind == SPACE)
    else:
        start = solid | (kind == NUMBER) | (new_run & (kind == SPACE))
    start |= kind == EDGE

    marks = np.flatnonzero((codes == 39) & solid & (kind == OTHER))
    if join_space:
        marks = marks[~blank_before[marks]]
    marks = marks[marks + 1 < n]
    marks = marks[kind[marks + 1] == LETTER]
    if len(marks):
        one = codes[marks + 1]
        two = np.where(marks + 2 < n, codes[np.minimum(marks + 2, n - 1)], 0)
        code = {c: ord(c) for c in "stmdrevl"}
        short = np.isin(one, [code[c] for c in "stmd"])
        long = ((one == code["r"]) | (one == code["v"])) & (two == code["e"]) | (one == code["l"]) & (two == code["l"])
        size = np.where(short, 2, np.where(long, 3, 0))
        marks, size = marks[size > 0], size[size > 0]
        start[marks + 1] = False
        rest = marks + size
        inside = rest < n
        start[rest[inside][kind[rest[inside]] == LETTER]] = True
    return start


def _safe_cuts(text: str) -> list[str]:
    """A very long text in parts; a single space between two words always starts a piece."""
    parts, at = [], 0
    while len(text) - at > CHUNK:
        cut = re.compile(r"(?<=\S) (?=\S)").search(text, at + CHUNK)
        if not cut:
            break
        parts.append(text[at : cut.start()])
        at = cut.start()
    parts.append(text[at:])
    return parts


def cut(
    texts: list[str | None],
    join_space: bool,
    library: Callable[[str], list[tuple[int, int]]],
    specials: tuple[str, ...] = (),
    ready: Callable[[str], str | None] = lambda t: t,
):
    """Yield ``Pieces`` for groups of texts, in order; ``rows`` are places in ``texts``.

    ``ready`` normalises a text, or answers None when only ``library`` may cut it. ``library`` answers the spans of
    a text's pieces. A special string is a piece of its own.
    """
    table = per_process("classes", _classes)
    special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
    parts, rows, whole = [], [], []
    for row, text in enumerate(texts):
        if not text:
            continue
        found = special.split(text) if special and any(s in text for s in specials) else [text]
        for i, part in enumerate(found):
            if i % 2:
                parts.append(part), rows.append(row), whole.append(True)
            elif part:
                for piece in _safe_cuts(part):
                    parts.append(piece), rows.append(row), whole.append(False)
    sizes = np.array([len(p) + 1 for p in parts], np.int64)
    for low, high in groups(sizes):
        yield _cut_group(parts[low:high], rows[low:high], whole[low:high], join_space, library, ready, table)


def _cut_group(parts, rows, whole, join_space, library, ready, table) -> Pieces:
    made = [p if w else ready(p) for p, w in zip(parts, whole, strict=True)]
    shown = [p if m is None else m for p, m in zip(parts, made, strict=True)]
    text = "\0".join(shown) + "\0"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = table[codes]
    ends = np.cumsum([len(p) + 1 for p in shown]) - 1
    begins = ends - np.array([len(p) for p in shown])
    kind[ends] = EDGE
    unsure = np.add.reduceat((kind == UNSURE).astype(np.int64), begins) > 0
    unsure |= np.array([m is None for m in made])
    unsure &= ~np.array(whole)
    start = word_starts(codes, kind, join_space)
    for i in np.flatnonzero(unsure | np.array(whole)):
        start[begins[i] : ends[i]] = False
        kind[begins[i] : ends[i]] = SPACE if not join_space else OTHER
        if whole[i]:
            start[begins[i]] = True
            kind[begins[i] : ends[i]] = OTHER
    firsts = np.flatnonzero(start)
    lasts = np.append(firsts[1:], len(codes))
    keep = kind[firsts] != EDGE
    if not join_space:
        keep &= kind[firsts] != SPACE
    firsts, lasts = firsts[keep], lasts[keep]
    extra = [(begins[i] + a, begins[i] + b) for i in np.flatnonzero(unsure) for a, b in library(shown[i])]
    if extra:
        firsts = np.concatenate([firsts, np.array([a for a, _ in extra])])
        lasts = np.concatenate([lasts, np.array([b for _, b in extra])])
        order = np.argsort(firsts, kind="stable")
        firsts, lasts = firsts[order], lasts[order]
    owner = np.asarray(rows)[np.searchsorted(ends, firsts, "left")]
    return Pieces(codes, owner, firsts, lasts)


class PieceTable:
    """Values of pieces already seen by this process, found by hash and compared as text; emptied when it is full."""

    def __init__(self, limit: int = 400_000):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.starts, self.ends = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.content, self.used = np.zeros(1 << 16, np.uint8), 0
        #: Pieces with the same hash, at most.
        self.most = 1
        self.values: list = []

    def slots_of(self, pieces: Pieces, value: Callable[[list[str]], list]) -> np.ndarray:
        """For each piece the place of its value in ``values``; unknown pieces are worked out once."""
        if len(self.keys) > self.limit:
            self.clear()
        which, content, offsets = distinct_words(pieces.codes, pieces.starts, pieces.ends)
        hashes = hash_spans(content, offsets[:-1], offsets[1:])
        found = self._known(hashes, content, offsets)
        new = np.flatnonzero(found < 0)
        if len(new):
            found[new] = len(self.values) + np.arange(len(new))
            self.values.extend(value([content[offsets[i] : offsets[i + 1]].tobytes().decode("utf-32-le", "surrogatepass") for i in new.tolist()]))
            self._add(hashes[new], found[new], *gathered(content, offsets[new], offsets[new + 1]))
        return found[which]

    def _known(self, hashes: np.ndarray, content: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The slots of pieces, -1 for unknown ones."""
        found = np.full(len(hashes), -1, np.int64)
        if not len(self.keys):
            return found
        sizes, first = np.diff(offsets), np.searchsorted(self.keys, hashes)
        for step in range(self.most):
            place = np.minimum(first + step, len(self.keys) - 1)
            slot = self.slots[place]
            maybe = np.flatnonzero((found < 0) & (self.keys[place] == hashes) & (self.ends[slot] - self.starts[slot] == sizes))
            ours, cuts = gathered(content, offsets[maybe], offsets[maybe + 1])
            theirs, _ = gathered(self.content, self.starts[slot[maybe]], self.ends[slot[maybe]])
            wrong = np.append(0, np.cumsum(ours != theirs))
            equal = maybe[wrong[cuts[1:]] == wrong[cuts[:-1]]]
            found[equal] = slot[equal]
        return found

    def _add(self, hashes: np.ndarray, slots: np.ndarray, content: np.ndarray, offsets: np.ndarray) -> None:
        while self.used + len(content) > len(self.content):
            self.content = np.concatenate([self.content, np.zeros(len(self.content), np.uint8)])
        self.content[self.used : self.used + len(content)] = content
        self.starts = np.concatenate([self.starts, self.used + offsets[:-1]])
        self.ends = np.concatenate([self.ends, self.used + offsets[1:]])
        self.used += len(content)
        keys = np.concatenate([self.keys, hashes])
        order = np.argsort(keys, kind="stable")
        self.keys, self.slots = keys[order], np.concatenate([self.slots, slots])[order]
        same = np.flatnonzero(np.append(True, self.keys[1:] != self.keys[:-1]))
        self.most = int(np.diff(np.append(same, len(self.keys))).max())
