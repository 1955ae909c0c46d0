"""Typed holders for the raw and the staged marketplace tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class RawMarketplace:
    """Inputs as they arrive: text columns still to be cleaned and cast."""

    sellers: DataFrame
    products: DataFrame
    category_translation: DataFrame
    orders: DataFrame
    order_items: DataFrame
    order_payments: DataFrame
    customers: DataFrame
    geolocation: DataFrame


@dataclass(frozen=True)
class Marketplace:
    """Staged, typed tables: the only input of marts, star schema and checks.

    ``customers`` and ``geolocation`` are cleaned but keep their raw grain
    (several customer ids per person, several points per zip code).
    """

    sellers: DataFrame
    products: DataFrame
    category_translation: DataFrame
    orders: DataFrame
    order_items: DataFrame
    order_payments: DataFrame
    customers: DataFrame
    geolocation: DataFrame

    def replace(self, **changes: DataFrame) -> "Marketplace":
        values = {f.name: getattr(self, f.name) for f in fields(self)}
        values.update(changes)
        return Marketplace(**values)

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


class LazyTables:
    """Tables by name, each built when it is first asked for.

    Stands in for ``RawMarketplace`` or ``Marketplace`` where building a table runs jobs that
    queries without that table should not pay for.
    """

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._builders:
            raise AttributeError(name)
        table = self._builders[name]()
        setattr(self, name, table)
        return table

    def replace(self, **changes: DataFrame) -> "LazyTables":
        return LazyTables({name: (lambda name=name: getattr(self, name)) for name in self._builders}
                          | {name: (lambda df=df: df) for name, df in changes.items()})

    def items(self):
        return [(name, getattr(self, name)) for name in self._builders]
