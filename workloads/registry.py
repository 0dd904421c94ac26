"""A named query and, where SQL can say it, its SQL."""

from __future__ import annotations


class Registry:
    def __init__(self) -> None:
        self.queries, self.oracle = {}, {}

    def add(self, name: str, sql: str | None = None):
        def keep(fn):
            self.queries[name] = fn
            if sql:
                self.oracle[name] = sql
            return fn

        return keep
