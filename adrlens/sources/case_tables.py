"""The six report tables of a study, whatever their origin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from adrlens.schemas import REPORT_TABLES


class CaseTables:
    """demo, drug, reac, indi, outc and rpsr, as attributes.

    A table may be given as a function; it is called when the table is first used, so a
    query over two tables does not prepare six.  ``versioned`` says whether any layout of the
    demographics has a case version; it may be a function too.
    """

    def __init__(self, versioned: bool | Callable[[], bool] = True,
                 **tables: DataFrame | Callable[[], DataFrame]):
        if set(tables) != set(REPORT_TABLES):
            raise ValueError(f"expected tables {REPORT_TABLES}, got {tuple(tables)}")
        self._tables, self._versioned = tables, versioned

    @property
    def versioned(self) -> bool:
        if not isinstance(self._versioned, bool):
            self._versioned = self._versioned()
        return self._versioned

    def __getattr__(self, name: str) -> DataFrame:
        if name not in REPORT_TABLES:
            raise AttributeError(name)
        given = self._tables[name]
        if not isinstance(given, DataFrame):
            given = self._tables[name] = given()
        return given

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in REPORT_TABLES]

    def map(self, change: Callable[[str, DataFrame], DataFrame]) -> "CaseTables":
        """The same tables with ``change(name, table)`` applied to each."""
        return CaseTables(versioned=lambda: self.versioned, **{name: lambda name=name: change(name, getattr(self, name))
                          for name in REPORT_TABLES})
