"""Publishing a stack of tables that read each other.

A stack names each table with its inputs; the order follows from that. A table that several others read is computed
once: a published one is read back from where it was published, an internal one is staged. A table with one reader
is part of that reader's plan, so that Catalyst sees through it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from marginloom.sources.tables import publish_table
from marginloom.staging import staged


class StackError(ValueError):
    """A table reads itself, or something that isn't there."""


@dataclass(frozen=True)
class Table:
    """``build`` gets the ``inputs`` in their order: other tables of the stack, or sources."""

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()


class Stack:
    def __init__(self, tables: dict[str, Table]):
        self.tables = tables

    def order(self, wanted: Iterable[str], sources: Iterable[str]) -> list[str]:
        """The tables that ``wanted`` needs, each after its inputs."""
        known, done, path = set(sources), [], []

        def visit(name: str) -> None:
            if name in known or name in done:
                return
            if name in path:
                raise StackError(f"{' reads '.join([*path[path.index(name):], name])}")
            if name not in self.tables:
                raise StackError(f"{path[-1] if path else 'the caller'} reads {name}, which is neither a table nor a source")
            path.append(name)
            for needed in self.tables[name].inputs:
                visit(needed)
            done.append(path.pop())

        for name in wanted:
            visit(name)
        return done

    def readers(self, order: list[str]) -> dict[str, int]:
        """How many inputs of the tables in ``order`` each name is."""
        inputs = [needed for name in order for needed in self.tables[name].inputs]
        return {name: inputs.count(name) for name in order}

    def build(
        self,
        sources: dict[str, DataFrame],
        wanted: Iterable[str],
        keep: Callable[[DataFrame, str], DataFrame | None] = lambda df, name: None,
    ) -> dict[str, DataFrame]:
        """The wanted tables. ``keep`` may store a wanted table and return what its readers are to read."""
        wanted = list(dict.fromkeys(wanted))
        order = self.order(wanted, sources)
        readers, found = self.readers(order), dict(sources)
        for name in order:
            table = self.tables[name]
            df = table.build(*[found[needed] for needed in table.inputs])
            stored = keep(df, name) if name in wanted else None
            if stored is None and readers[name] + (name in wanted) > 1:
                stored = staged(df, name)
            found[name] = df if stored is None else stored
        return {name: found[name] for name in wanted}

    def publish(
        self, sources: dict[str, DataFrame], names: dict[str, str], partition_by: dict[str, list[str]] | None = None
    ) -> dict[str, DataFrame]:
        """Publishes tables under the given names, inputs first, and returns them as they are read back.

        ``names``: table of the stack to name in the catalog. Each name switches when its table is complete; if a
        table fails, it and all after it keep their old contents.
        """

        def keep(df: DataFrame, name: str) -> DataFrame:
            publish_table(df, names[name], (partition_by or {}).get(name))
            return df.sparkSession.table(names[name])

        return self.build(sources, names, keep)
