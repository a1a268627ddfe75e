"""Dataset configurations: strict TOML records."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path

from .operators.validation import Expected
from .sources import files


@dataclass(frozen=True)
class Config:
    name: str
    adapter: str
    title: str = ""
    license: str = ""
    citation: str = ""
    synthetic: bool = False
    visibility: str = "public"
    seed: int = 0
    source: str | None = None
    path: str | None = None
    images: str | None = None
    recompute_in: str | None = None
    scale_factor: float = 1e4
    core_radius_um: float = 500.0
    n_patients: int | None = None
    target_cells: int = 0
    min_cores: int = 0
    n_sections: int = 1
    split_largest: int = 0
    max_total_bytes: int = 5_000_000_000
    expected: Expected = field(default_factory=Expected)

    @staticmethod
    def of(record: dict) -> Config:
        """A configuration of a record; unknown keys are an error."""
        for kind, part in ((Config, record), (Expected, record.get("expected", {}))):
            if unknown := set(part) - {f.name for f in fields(kind)}:
                raise ValueError(f"unknown keys: {', '.join(sorted(unknown))}")
        return Config(**{**record, "expected": Expected(**record.get("expected", {}))})

    @staticmethod
    def read(folder: str | Path, name: str) -> Config:
        return Config.of(files.config(folder, name))
