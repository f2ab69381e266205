"""Results of an analysis: named tables, each planned when it is first asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any


class Tables(Mapping):
    """Read-only mapping from table name to DataFrame (or plain value)."""

    def __init__(self, makers: dict[str, Callable[[], Any]], **values: Any) -> None:
        self._makers = makers
        self._ready: dict[str, Any] = dict(values)

    def __getitem__(self, name: str) -> Any:
        if name not in self._ready:
            self._ready[name] = self._makers[name]()
        return self._ready[name]

    def __iter__(self) -> Iterator[str]:
        return iter([*(k for k in self._ready if k not in self._makers), *self._makers])

    def __len__(self) -> int:
        return len(set(self._ready) | set(self._makers))
