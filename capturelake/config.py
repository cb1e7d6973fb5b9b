"""Settings with defaults, and NAME=V1,V2 field arguments."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable


@dataclasses.dataclass(frozen=True)
class Config:
    """base: folder of all tables. parse_mode: what to do with damaged archives. strict_mime: see functions.mime."""

    base: str
    parse_mode: str = "PERMISSIVE"
    strict_mime: bool = True
    commit_retries: int = 10
    retry_seconds: float = 1.0
    lock_seconds: float = 3600.0
    archives_per_job: int = 500
    docs_per_page: int = 10_000
    ids_per_page: int = 100_000
    #: of a part's documents by id; a part keeps those it was written with
    buckets: int = 8

    @classmethod
    def read(cls, lines: Iterable[str], **overrides) -> Config:
        """From ``key=value`` lines; overrides win, unknown keys raise."""
        kinds = {f.name: f.type for f in dataclasses.fields(cls)}
        found = {}
        for line in lines:
            key, eq, value = line.partition("=")
            key = key.strip()
            if not eq or key.startswith("#"):
                continue
            if key not in kinds:
                raise ValueError(f"no setting {key!r}")
            value = value.strip().strip('"')
            found[key] = value.lower() == "true" if kinds[key] == "bool" else int(value) if kinds[key] == "int" else float(value) if kinds[key] == "float" else value
        return cls(**found | overrides)


def fields(arguments: Iterable[str]) -> dict[str, list[str]]:
    """NAME=V1,V2 arguments as lists of values."""
    out: dict[str, list[str]] = {}
    for a in arguments:
        name, eq, values = a.partition("=")
        if not eq or not name:
            raise ValueError(f"no NAME=VALUE: {a!r}")
        out[name] = values.split(",")
    return out
