"""Folders of files of formats that Spark does not know: which of them a reader takes, and how tasks write them.

A task writes files under hidden names, which no reader takes, and tells the driver; only when all tasks have ended are the
files of the attempts that count given their names. A failed job leaves nothing that is read.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSourceWriter, WriterCommitMessage


def plain(path: str) -> str:
    """The path for file access, on storage that all executors mount."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        raise ValueError(f"{path} is not on mounted storage")
    return path


def listed(options, *endings: str) -> list[str]:
    """The files that the option path (a file or folder) or paths (several, with commas between) names, in order; of a folder those
    with one of the endings whose names are not hidden."""
    given = options.get("paths") or options.get("path")
    if not given:
        raise ValueError("the option path or paths is needed")
    out = []
    for path in map(plain, given.split(",")):
        if os.path.isdir(path):
            out += [os.path.join(path, n) for n in sorted(os.listdir(path)) if n.lower().endswith(endings) and n[0] not in "._"]
        else:
            out.append(path)
    return out


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class FolderWriter(DataSourceWriter):
    """Writes a folder; formats say how a task's rows become files (`put`: for each file it yields once `path` is whole)."""

    ending = ""

    def __init__(self, options, schema, overwrite: bool):
        self.folder, self.options, self.schema, self.overwrite, self.job = plain(options["path"]), dict(options), schema, overwrite, uuid.uuid4().hex
        self.check()

    def check(self) -> None:
        """An error for columns that the format cannot hold."""

    def put(self, rows: Iterator, path) -> Iterator[str]:
        """Writes files, each to a name that path() gives, and yields the names."""
        raise NotImplementedError

    def write(self, iterator):
        os.makedirs(self.folder, exist_ok=True)
        name = lambda: os.path.join(self.folder, f".{self.job}-{uuid.uuid4().hex}")
        return _Written([os.path.basename(p) for p in self.put(iterator, name)])

    def commit(self, messages) -> None:
        os.makedirs(self.folder, exist_ok=True)
        old = listed({"path": self.folder}, self.ending) if self.overwrite else []
        done = [n for m in messages if m is not None for n in m.names]
        for k, name in enumerate(done):
            os.replace(os.path.join(self.folder, name), os.path.join(self.folder, f"part-{self.job}-{k:06d}{self.ending}"))
        for path in old:
            os.unlink(path)
        self._clear()

    def abort(self, messages) -> None:
        self._clear()

    def _clear(self) -> None:
        """Files of attempts that do not count."""
        if os.path.isdir(self.folder):
            for name in os.listdir(self.folder):
                if name.startswith(f".{self.job}-"):
                    os.unlink(os.path.join(self.folder, name))
