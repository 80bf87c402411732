"""Registered queries: the operators over the given tables, with the SQL that checks them."""

from __future__ import annotations


class Registry:
    """Query functions (spark, sf_dir) → DataFrame and their check SQL, by name."""

    def __init__(self):
        self.queries: dict = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, oracle: str | None = None):
        def add(fn):
            self.queries[name] = fn
            if oracle is not None:
                self.oracles[name] = oracle
            return fn

        return add


REGISTRY = Registry()


def load_all() -> Registry:
    from ratelake.plans import folders, gates, pages, rates, runs, scalars, streams  # noqa: F401

    return REGISTRY
