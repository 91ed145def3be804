"""A bounded memory of computed values for the inside of tasks."""

from __future__ import annotations


class Lookup(dict):
    """Values by key, computed when they are first asked for.

    Two generations bound the memory: when the young one is full it becomes the old one, and the
    keys of the old one that are asked for again come back.  Long keys are never kept.  There is one
    instance for each process and set of arguments, so that reused workers keep what they know.
    """

    SIZE = 300_000
    LONGEST = 64

    def __init__(self):
        super().__init__()
        self._old: dict = {}

    @classmethod
    def shared(cls, *arguments):
        # Set on first use, not in the class body, where unpickling the class again would reset it.
        made = cls.__dict__.get("_made")
        if made is None:
            cls._made = made = {}
        if arguments not in made:
            made[arguments] = cls(*arguments)
        return made[arguments]

    def compute(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) < self.LONGEST:
            if len(self) >= self.SIZE:
                self._old = self.copy()
                self.clear()
            self[key] = value
        return value
