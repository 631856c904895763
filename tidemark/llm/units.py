"""Token ids by cached units: pieces of a text that a tokenizer always encodes alike, wherever they stand."""

from __future__ import annotations

from collections.abc import Callable, Iterable

CACHED_UNITS = 1_200_000
CACHED_LENGTH = 48


class UnitCache:
    """Encodes lists of units; remembers short ones, up to a fixed number, for later texts.

    The bound limits memory alone: what is not remembered is encoded again.
    """

    def __init__(self, encode: Callable[[list[str]], list], size: int = CACHED_UNITS):
        self._encode, self._size, self._known = encode, size, {}

    def __call__(self, unit_lists: Iterable[list[str]]) -> list[list]:
        """The encoded units of every list, in order."""
        unit_lists = list(unit_lists)
        missing = set()
        for units in unit_lists:
            missing.update(units)
        missing.difference_update(self._known)
        if len(self._known) + len(missing) > self._size:
            self._known = {}
            missing = set()
            for units in unit_lists:
                missing.update(units)
        new = list(missing)
        self._known.update(zip(new, self._encode(new), strict=True))
        known = self._known.__getitem__
        found = [list(map(known, units)) for units in unit_lists]
        for unit in new:
            if len(unit) > CACHED_LENGTH:
                del self._known[unit]
        return found


class UnitTable(dict):
    """Like ``UnitCache`` for a function of one unit: looks up, or works out and remembers."""

    def __init__(self, encode: Callable, size: int = CACHED_UNITS):
        super().__init__()
        self._encode, self._size = encode, size

    def __missing__(self, unit: str):
        value = self._encode(unit)
        if len(unit) <= CACHED_LENGTH:
            if len(self) >= self._size:
                self.clear()
            self[unit] = value
        return value


def runs(items: Iterable, size: Callable, most: int) -> Iterable[list]:
    """Consecutive items in lists of at most about ``most`` by ``size``; one large item stands alone."""
    held, total = [], 0
    for item in items:
        weight = size(item)
        if held and total + weight > most:
            yield held
            held, total = [], 0
        held.append(item)
        total += weight
    if held:
        yield held
