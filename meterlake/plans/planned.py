"""Named frames that are planned on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Planned(Mapping[str, DataFrame]):
    """A read-only mapping of names to frames; analysing a plan costs driver time, so unused names cost nothing."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders, self._built = dict(builders), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
