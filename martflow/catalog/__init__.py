"""Every operator as a query over the driver tables, with its SQL where SQL can say it."""

from __future__ import annotations

from martflow.catalog import changes, checks, columns, extracts, incremental, marts, retrieval, storage, stream

MODULES = [marts, extracts, columns, changes, storage, checks, retrieval, stream, incremental]


def entries() -> dict:
    """name -> (query function, SQL or None)."""
    found: dict = {}
    for module in MODULES:
        for name, entry in module.ENTRIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = entry
    return found
