"""Table handles.

A table is either a folder plus a format, or a name in the session catalog
(a metastore table, ``db.table``). The format defaults to parquet; "delta"
passes straight through to the reader and writer when its package is on
the classpath.
"""

from __future__ import annotations

from dataclasses import dataclass

DEFAULT_FORMAT = "parquet"
CATALOG_PREFIX = "catalog:"


@dataclass(frozen=True)
class LinkTable:
    path: str | None = None
    fmt: str = DEFAULT_FORMAT
    name: str | None = None  # catalog table name, used instead of a path

    def __post_init__(self) -> None:
        if not self.path and not self.name:
            raise ValueError("a table needs a non-empty path or catalog name")

    @classmethod
    def catalog(cls, name: str, fmt: str = DEFAULT_FORMAT) -> "LinkTable":
        return cls(None, fmt, name)

    @property
    def in_catalog(self) -> bool:
        return self.name is not None

    def child(self, name: str) -> "LinkTable":
        if self.in_catalog:
            raise ValueError("catalog tables have no child folders")
        return LinkTable(f"{self.path.rstrip('/')}/{name}", self.fmt)

    def __str__(self) -> str:
        return self.name if self.in_catalog else self.path


def as_table(table: "LinkTable | str", fmt: str = DEFAULT_FORMAT) -> LinkTable:
    """A handle from a handle, a path, or ``catalog:db.table``."""
    if isinstance(table, LinkTable):
        return table
    if table.startswith(CATALOG_PREFIX):
        return LinkTable.catalog(table[len(CATALOG_PREFIX):], fmt)
    return LinkTable(table, fmt)
