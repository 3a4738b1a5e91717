"""Variables as plug-ins: where each one's pixels or records come from and what is done to them afterwards."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from ..operators.grids import Layer
from . import catalog

#: (areas, year, season, resolution) to a table, or to a table and the resolution that it really has; a raster may be a layer, whose grids say it all.
Extractor = Callable[[DataFrame, "int | str", str, "float | None"], "DataFrame | Layer | tuple[DataFrame | Layer, float]"]
Options = Mapping[str, Any]


def _unchanged(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class Variable:
    """``extractor`` and ``transform`` are made from a job's options; a transform is what ``df.transform`` takes."""

    extractor: Callable[[Options], Extractor]
    transform: Callable[[Options], Callable[[DataFrame], DataFrame]] = lambda options: _unchanged
    kind: str = "raster"
    ext: str | Callable[[Options], str] = "tif"
    timed: bool = True  # whether outputs carry a year and a season


class Variables:
    """Plug-ins by name, in any case of its letters."""

    def __init__(self) -> None:
        self._known: dict[str, Variable] = {}

    def add(self, name: str, variable: Variable) -> None:
        if name.lower() in self._known:
            raise ValueError(f"{name} is registered twice")
        self._known[name.lower()] = variable

    def names(self) -> list[str]:
        return sorted(self._known)

    def get(self, name: str) -> Variable:
        if name.lower() not in self._known:
            raise ValueError(f"unknown variable {name}, known are {', '.join(self.names())}")
        return self._known[name.lower()]

    def ext(self, name: str, options: Options | None = None) -> str:
        ext = self.get(name).ext
        return ext(options or {}) if callable(ext) else ext

    def layer(self, name: str, areas: DataFrame, year: int | str, season: str, resolution: float | None = None, options: Options | None = None) -> tuple[DataFrame | Layer, float | None]:
        """A variable's table and its resolution: what the extractor says, else what was asked for, else the catalogue's. Of a layer the pixels are transformed."""
        variable, options = self.get(name), options or {}
        found = variable.extractor(options)(areas, year, season, resolution)
        df, real = found if isinstance(found, tuple) else (found, resolution)
        if real is None:
            real = next((known[1] for known in catalog.VARIABLES if known[0] == name.lower()), None)
        change = variable.transform(options)
        return Layer(df.pixels.transform(change), df.grids) if isinstance(df, Layer) else df.transform(change), real
