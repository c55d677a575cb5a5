"""A bounded memory of computed values for Python workers."""

from __future__ import annotations

from collections.abc import Callable


class TwoGenerations(dict):
    """``cache[key]`` is ``make(key)``, remembered for the keys used lately.

    At ``size`` entries the current generation becomes the old one and a new one begins; an entry found in the old one moves over.
    So at most twice ``size`` entries are held, and a frequent key is never lost.  Keys longer than ``longest`` aren't kept.
    """

    def __init__(self, make: Callable, size: int, longest: int):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(key) > self.longest:
            return
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
