"""Reading a byte-level BPE vocabulary file of the tokenizers library."""

from __future__ import annotations

import json
from dataclasses import dataclass


def byte_letters() -> dict[str, int]:
    """The printable letter of each byte in such files: itself where printable, else the next free one from U+0100."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))})
    return letters


@dataclass
class Vocabulary:
    """``merges`` maps a pair of ids, as ``left << 20 | right``, to (rank, id); ``labels`` are the bytes of the ids."""

    byte_ids: list[int]
    merges: dict[int, tuple[int, int]]
    labels: dict[int, bytes]
    specials: dict[str, int]


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, letters = content["model"], byte_letters()
    ids = model["vocab"]
    labels = {i: bytes(letters[c] for c in token) for token, i in ids.items()}
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges.setdefault(ids[left] << 20 | ids[right], (rank, ids[left + right]))
    specials = {t["content"]: t["id"] for t in content["added_tokens"]}
    labels.update({i: s.encode() for s, i in specials.items()})
    letter_of = {b: c for c, b in letters.items()}
    return Vocabulary([ids[letter_of[b]] for b in range(256)], merges, labels, specials)
