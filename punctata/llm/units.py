"""Cached encoding of texts by units cut at boundaries that no token can cross."""

from __future__ import annotations

import re
from collections.abc import Callable

#: Runs in which cutting at every space is not safe: long white space, or white space at the end.
_GAPS = re.compile(r"\s{3}|\s\s$|^\s\s")
_SAFE = re.compile(r"(?<=\S) (?=\S)")
#: White space but the space and the line feed, and runs of those two: without any, no run is longer than one.
_RARE = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_RUNS = ("  ", " \n", "\n ", "\n\n")
_ASCII_RARE = tuple(c for c in _RARE if c.isascii())


class UnitCache:
    """Values of units, kept in two generations so that frequent units survive.

    ``compute`` takes a list of units that are new here and returns their values in order. At most
    ``2 * most`` units are held; a unit that was forgotten is computed again, so results never
    depend on the cache.
    """

    def __init__(self, compute: Callable[[list[str]], list], most: int = 500_000):
        self.compute, self.most = compute, most
        self.young: dict = {}
        self.old: dict = {}

    def values(self, units: list[str]) -> list:
        """The value of each unit."""
        young = self.young
        out = list(map(young.get, units))
        if None in out:
            at = [i for i, v in enumerate(out) if v is None]
            missed = [units[i] for i in at]
            if self.old:
                young.update({x: v for x, v in zip(missed, map(self.old.get, missed)) if v is not None})
                fresh = [x for x in dict.fromkeys(missed) if x not in young]
            else:
                fresh = list(dict.fromkeys(missed))
            if fresh:
                young.update(zip(fresh, self.compute(fresh), strict=True))
            for i, v in zip(at, map(young.get, missed)):
                out[i] = v
        if len(young) > self.most:
            self.old, self.young = young, {}
        return out


def is_spaced(text: str) -> bool:
    """Whether no token of a byte-level pattern can cross any single space of ``text``: no long white space runs."""
    odd = any(x in text for x in _RUNS) or any(c in text for c in (_ASCII_RARE if text.isascii() else _RARE))
    return not (odd and _GAPS.search(text))


def safe_units(text: str) -> list[str]:
    """Any text cut at single spaces between two non-space characters; the space itself is left out."""
    return _SAFE.split(text)
