"""Texts as arrays of letter codes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

PIECE = 1 << 20  # characters turned into codes at once
SPACE = 32


@cache
def letter_table() -> np.ndarray:
    """Code points below 65536 to lower-case letters; everything else to a space."""
    table = np.full(0x10000, SPACE, np.uint32)
    for code in range(0x10000):
        if chr(code).isalpha():
            low = chr(code).lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def pieces(text: str) -> Iterator[str]:
    """The text in pieces of bounded size, cut at a space where there is one."""
    at = 0
    while len(text) - at > PIECE:
        cut = text.rfind(" ", at + 1, at + PIECE)
        cut = at + PIECE if cut < 0 else cut
        yield text[at:cut]
        at = cut
    yield text[at:]


def letter_codes(piece: str) -> np.ndarray:
    """Lower-case letters with one space between words, before the first and after the last."""
    codes = np.frombuffer(f" {piece} ".encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(codes < 0x10000, letter_table()[np.minimum(codes, 0xFFFF)], codes)
    blank = codes == SPACE
    return codes[~(blank & np.r_[False, blank[:-1]])]
