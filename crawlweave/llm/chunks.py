"""Byte-level BPE texts in pieces that repeat, so that each different piece is encoded once.

A pre-token of the byte-level pattern never runs from a visible character into white space, so a text may be cut
before any single blank without changing its tokens.
"""

from __future__ import annotations

from collections.abc import Callable

Encode = Callable[[list[str]], list[bytes]]


class PieceCache:
    """ids of whole texts as little-endian unsigned 32-bit integers.

    ``encode`` gives the ids of new pieces; ``split`` cuts a text that holds runs of blanks. ``limit`` bounds the
    pieces that are remembered, not what is encoded. ``special`` maps literal strings to their ids.
    """

    def __init__(self, encode: Encode, split: Callable[[str], list[str]], special: dict[str, int], limit: int = 100_000):
        self.encode, self.split, self.special, self.limit = encode, split, special, limit
        self.known: dict[str, bytes] = {}  # pieces that follow a blank, without it
        self.heads: dict[str, bytes] = {}  # pieces as they are

    def _learn(self, tails: set[str], heads: set[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """The ids of pieces that are not known; remembered while there is room."""
        new_tails, new_heads = list(tails), list(heads)
        found = self.encode([" " + x for x in new_tails] + new_heads)
        more = dict(zip(new_tails, found)), dict(zip(new_heads, found[len(new_tails) :]))
        if len(self.known) + len(self.heads) < self.limit:
            self.known.update(more[0])
            self.heads.update(more[1])
        return more

    def _parts(self, text: str) -> list[tuple[bool, list[str]]]:
        return [(False, self.split(text))] if "  " in text else [(True, text.split(" "))]

    def _cut(self, text: str) -> list:
        """Lists of pieces as ``_parts`` gives them, and between them the ids of special strings."""
        parts: list = []
        rest = text
        while marks := [(rest.find(s), s) for s in self.special if s in rest]:
            at, mark = min(marks)
            parts += self._parts(rest[:at])
            parts.append(self.special[mark].to_bytes(4, "little"))
            rest = rest[at + len(mark) :]
        return parts + self._parts(rest)

    def texts(self, texts: list[str]) -> list[bytes]:
        """ids of each text."""
        cut = [self._cut(text) for text in texts]
        tails: set[str] = set()
        heads: set[str] = set()
        done: list[list] = []  # of each text its parts: ids, pieces, whether the pieces but the first follow a blank
        for parts in cut:
            row: list = []
            for part in parts:
                if isinstance(part, bytes):
                    row.append(([part], [], False))
                    continue
                spaced, pieces = part
                if spaced:
                    ids = [self.heads.get(pieces[0]), *map(self.known.get, pieces[1:])]
                else:
                    ids = list(map(self.heads.get, pieces))
                if None in ids:
                    new = [p for p, x in zip(pieces, ids) if x is None]
                    if not spaced:
                        heads.update(new)
                    elif ids[0] is None:
                        heads.add(new[0])
                        tails.update(new[1:])
                    else:
                        tails.update(new)
                row.append((ids, pieces, spaced))
            done.append(row)
        more_tails, more_heads = self._learn(tails, heads) if heads or tails else ({}, {})
        out = []
        for row in done:
            for ids, pieces, spaced in row:
                if None in ids:
                    if spaced and ids[0] is None:
                        ids[0] = more_heads[pieces[0]]
                    table = more_tails if spaced else more_heads
                    ids[:] = [table[p] if x is None else x for p, x in zip(pieces, ids)]
            out.append(b"".join(row[0][0] if len(row) == 1 else [x for ids, _, _ in row for x in ids]))
        return out


class Memo(dict):
    """Values that are worked out where they are first asked for."""

    def __init__(self, work: Callable[[str], bytes]):
        super().__init__()
        self.work = work

    def __missing__(self, key: str) -> bytes:
        value = self[key] = self.work(key)
        return value

    def forget(self, limit: int) -> None:
        """Drop the newest beyond ``limit``."""
        for _ in range(len(self) - limit):
            self.popitem()


class PieceMemo(PieceCache):
    """The same with encoders of one piece, that behind a blank or as it is, called while the texts are gone through once."""

    def __init__(
        self, tail: Callable[[str], bytes], head: Callable[[str], bytes], split: Callable[[str], list[str]], special: dict[str, int], limit: int = 100_000
    ):
        super().__init__(lambda pieces: [*map(head, pieces)], split, special, limit)
        self.known, self.heads = Memo(tail), Memo(head)

    def texts(self, texts: list[str]) -> list[bytes]:
        out = []
        tail, head = self.known.__getitem__, self.heads.__getitem__
        for text in texts:
            ids: list[bytes] = []
            for part in self._cut(text):
                if isinstance(part, bytes):
                    ids.append(part)
                    continue
                spaced, pieces = part
                if spaced:
                    first, *pieces = pieces
                    ids.append(head(first))
                ids += map(tail if spaced else head, pieces)
            out.append(b"".join(ids))
        self.heads.forget(self.limit // 4)
        self.known.forget(self.limit)
        return out
