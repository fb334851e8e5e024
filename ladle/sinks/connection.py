"""Typed options of a database target: a connection, and the settings of a load merged over its defaults."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

#: Settings that a connection has unless told otherwise, and the type of each.
DEFAULT_SETTINGS = {"batchsize": 500, "isolationLevel": "NONE", "queryTimeout": 30, "truncate": False, "numPartitions": 0}
ISOLATION_LEVELS = ("NONE", "READ_UNCOMMITTED", "READ_COMMITTED", "REPEATABLE_READ", "SERIALIZABLE")


def checked_settings(settings: Mapping[str, object]) -> dict[str, object]:
    """``settings`` with known names and values of their types, else an error; other names are the driver's own and pass as text."""
    out = {}
    for name, value in settings.items():
        known = DEFAULT_SETTINGS.get(name)
        if isinstance(known, bool):
            if not isinstance(value, bool):
                raise ValueError(f"{name} must be true or false")
        elif isinstance(known, int):
            if isinstance(value, bool) or not isinstance(value, int) or value < 0:
                raise ValueError(f"{name} must be a whole number of 0 or more")
        elif name == "isolationLevel" and value not in ISOLATION_LEVELS:
            raise ValueError(f"isolationLevel must be one of {', '.join(ISOLATION_LEVELS)}")
        out[name] = value
    return out


@dataclass(frozen=True)
class Connection:
    """Where a database table is and how it is reached. ``settings`` go over :data:`DEFAULT_SETTINGS`, a load's own over both."""

    url: str
    table: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    settings: Mapping[str, object] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.url.startswith("jdbc:"):
            raise ValueError("A connection's url begins with jdbc:")
        if not self.table.strip():
            raise ValueError("A connection names a table")
        if self.password is not None and self.user is None:
            raise ValueError("A password goes with a user")
        checked_settings(self.settings)

    def with_settings(self, **settings: object) -> "Connection":
        return replace(self, settings={**self.settings, **settings})

    def writer_options(self, settings: Mapping[str, object] | None = None) -> dict[str, str]:
        """Options for Spark's ``jdbc`` writer and reader: defaults, the connection's settings, then ``settings``."""
        whole = DEFAULT_SETTINGS | checked_settings(self.settings) | checked_settings(settings or {})
        if not whole["numPartitions"]:
            del whole["numPartitions"]  # as many writers as tasks
        own = {"url": self.url, "dbtable": self.table, "user": self.user, "password": self.password, "driver": self.driver}
        text = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in whole.items()}
        return text | {k: v for k, v in own.items() if v is not None}
