"""Piecewise use of a public byte-level BPE vocabulary.

White space ends every pre-token of these vocabularies, so a text falls into
independent pieces.  Texts of a corpus repeat most pieces; a distinct piece is
encoded once per Python worker while it stays in a bounded cache.
"""

from __future__ import annotations

from collections.abc import Callable

# White space as Unicode defines it (fixed value; Python's \s has more).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    itself where printable in Latin-1, else the next one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class PieceCache:
    """piece -> packed ids, in two halves: when the young one holds ``limit``
    pieces it becomes the old one, from which pieces still in use come back."""

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], limit: int = 200_000):
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.encode_many, self.limit = encode_many, limit

    def packed(self, pieces: list[str]) -> bytes:
        """Ids of pieces in a row."""
        distinct = set(pieces)
        new = distinct.difference(self.known)
        if len(self.known) + len(new) > self.limit:
            self.old, self.known, new = self.known, {}, distinct
        # one look-up a piece: an intersection with a dict would go through all of it
        back = {p: self.old[p] for p in new if p in self.old}
        self.known.update(back)
        new = list(new.difference(back))
        if new:
            self.known.update(zip(new, self.encode_many(new)))
        return b"".join(map(self.known.__getitem__, pieces))
