"""Lazily built table mappings."""

from __future__ import annotations


class Lazy(dict):
    """Mapping of table name -> DataFrame built on first access.

    Building a DataFrame costs driver round trips; lazy tables let concurrent
    stages each build only what they read."""

    def __init__(self, factories):
        super().__init__()
        self._factories = factories

    def __getitem__(self, key):
        if not dict.__contains__(self, key):
            dict.__setitem__(self, key, self._factories[key]())
        return dict.__getitem__(self, key)

    def __contains__(self, key):
        return key in self._factories

    def __iter__(self):
        return iter(self._factories)

    def __len__(self):
        return len(self._factories)

    def keys(self):
        return self._factories.keys()

    def items(self):
        return [(k, self[k]) for k in self._factories]

    def values(self):
        return [self[k] for k in self._factories]
