"""The ledger of a bronze folder: which landings were begun, which are whole, and what they hold.

Below the folder lies ``_landings`` with two small files for each batch. ``started`` is made before the
first row is written and names the run's folder; ``landed`` is made after the last and adds the header
and the numbers of rows, files and bytes. A run that was begun and is not whole is not read.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from urllib.parse import quote

from assay.workspace import Files

LANDINGS = "_landings"
_STARTED, _LANDED = ".started.json", ".landed.json"
_READERS = 16


@dataclass(frozen=True)
class Landing:
    """A run's folder below bronze and, if it is whole, what lies in it."""

    folder: str
    header: tuple[str, ...] = ()
    rows: int = 0
    files: int = 0
    bytes: int = 0


def _entry(bronze: str, batch: str, kind: str) -> str:
    return f"{bronze.rstrip('/')}/{LANDINGS}/{quote(batch, safe='')}{kind}"


def _parsed(text: str | None) -> Landing | None:
    try:
        found = json.loads(text) if text is not None else None
    except ValueError:
        return None  # cut off when its writer was killed
    return Landing(**{**found, "header": tuple(found["header"])}) if isinstance(found, dict) else None


def find(files: Files, bronze: str, batch: str) -> tuple[Landing | None, Landing | None]:
    """A batch as it was started, and as it landed."""
    started, landed = (_parsed(files.read(_entry(bronze, batch, kind))) for kind in (_STARTED, _LANDED))
    return started, landed


def _note(files: Files, bronze: str, batch: str, kind: str, landing: Landing) -> None:
    path = _entry(bronze, batch, kind)
    if not files.create(path, json.dumps(asdict(landing))):
        files.delete(path)  # of a writer that was killed while it made the file
        files.create(path, json.dumps(asdict(landing)))


def start(files: Files, bronze: str, batch: str, folder: str) -> None:
    _note(files, bronze, batch, _STARTED, Landing(folder))


def finish(files: Files, bronze: str, batch: str, landing: Landing) -> None:
    _note(files, bronze, batch, _LANDED, landing)


def ledger(files: Files, bronze: str) -> tuple[dict[str, Landing], set[str]]:
    """Whole runs by their folder, and the folders of runs that are not whole."""
    folder = f"{bronze.rstrip('/')}/{LANDINGS}"
    names = [name for name, _ in files.list(folder)]
    with ThreadPoolExecutor(_READERS) as readers:
        entries = list(readers.map(lambda name: _parsed(files.read(f"{folder}/{name}")), names))
    whole = {e.folder: e for name, e in zip(names, entries) if e is not None and name.endswith(_LANDED)}
    begun = {e.folder for name, e in zip(names, entries) if e is not None and name.endswith(_STARTED)}
    return whole, begun - whole.keys()
