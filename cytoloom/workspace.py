"""The folders of a data volume, and a journal that keeps single cells of private data out."""

from __future__ import annotations

import logging
import os
import sys
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path
from typing import TextIO

CODE = Path(__file__).resolve()
KINDS = ("raw", "canonical", "derived", "build")


class WorkspaceError(RuntimeError):
    pass


@dataclass(frozen=True)
class Workspace:
    """A data volume; its folders are <kind>/<dataset>."""

    root: Path

    @staticmethod
    def open(env: Mapping[str, str] = os.environ) -> Workspace:
        """The volume that DATA_ROOT names. It must be another one than that of the code, unless CYTOLOOM_ALLOW_SAME_VOLUME=1."""
        try:
            root = Path(env["DATA_ROOT"])
            device = root.stat().st_dev if root.is_dir() else None
        except KeyError:
            raise WorkspaceError("DATA_ROOT names no volume; set it") from None
        shared_allowed = env.get("CYTOLOOM_ALLOW_SAME_VOLUME", "") == "1"
        if device is None:
            raise WorkspaceError(f"nothing is mounted at {root}")
        if device == CODE.stat().st_dev and not shared_allowed:
            raise WorkspaceError(f"data at {root} would share the volume of the code")
        return Workspace(root)

    def folder(self, kind: str, dataset: str) -> Path:
        if kind not in KINDS:
            raise ValueError(f"no folder of kind {kind!r}")
        return self.root.joinpath(kind, dataset)


class Journal(logging.Handler):
    """The one handler of a run's records: each is judged once, then written to standard output and its files.

    Records marked extra={"cell_level": True} tell of single cells; with private data they
    are counted in `withheld` and go nowhere.
    """

    def __init__(self, private: bool = False, files: tuple[TextIO, ...] = ()):
        super().__init__(logging.INFO)
        self.private, self.files, self.withheld = private, files, 0
        self.setFormatter(logging.Formatter("{asctime} {levelname:<7} {message}", "%H:%M:%S", "{"))

    def emit(self, record: logging.LogRecord) -> None:
        if self.private and record.__dict__.get("cell_level"):
            self.withheld += 1
            return
        line = self.format(record) + "\n"
        for sink in (sys.stdout, *self.files):
            sink.write(line)
            sink.flush()


def journal(path: str | os.PathLike | None = None, private: bool = False) -> Journal:
    """Starts a journal of this package's records, on standard output and in a new file; an earlier one ends. Spark speaks from warnings on."""
    package = logging.getLogger(__package__)
    for earlier in [h for h in package.handlers if isinstance(h, Journal)]:
        package.removeHandler(earlier)
        for file in earlier.files:
            file.close()
    files = ()
    if path is not None:
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
        files = (open(path, "w", encoding="utf-8"),)
    started = Journal(private, files)
    package.addHandler(started)
    package.setLevel(logging.INFO)
    package.propagate = False
    for spark in ("py4j", "pyspark"):
        logging.getLogger(spark).setLevel(logging.WARNING)
    return started
