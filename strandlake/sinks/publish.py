"""A set of outputs of one folder, published together or not at all."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

from .files import disk_of, local_path


class AtomicOutputs:
    """Stage files or folders beside their targets, then swap all of them in.

    ``stage(name)`` gives a path to write; ``remove(name)`` marks a stale
    output. ``publish()`` moves old outputs to a backup, new ones in, and puts
    everything back if a step fails. Leaving the context without publishing
    drops what was staged.
    """

    def __init__(self, directory: str, spark: SparkSession | None = None):
        self.disk = disk_of(directory, spark)
        self.directory = (local_path(directory) or directory).rstrip("/") or "/"
        self.disk.make(self.directory)
        self.staging = f"{self.directory}/.staging-{uuid.uuid4().hex}"
        self.disk.make(self.staging)
        self.staged: list[str] = []
        self.stale: list[str] = []

    def __enter__(self) -> AtomicOutputs:
        return self

    def __exit__(self, *_) -> None:
        self.disk.remove(self.staging)

    @staticmethod
    def _plain(name: str) -> str:
        if not name or os.path.basename(name) != name:
            raise ValueError(f"{name!r} is not a plain name")
        return name

    def stage(self, name: str) -> str:
        if name in self.staged:
            raise ValueError(f"{name} is staged twice")
        self.staged.append(self._plain(name))
        return f"{self.staging}/{name}"

    def remove(self, name: str) -> None:
        self.stale.append(self._plain(name))

    def publish(self) -> None:
        for name in self.staged:
            if not self.disk.exists(f"{self.staging}/{name}"):
                raise FileNotFoundError(f"{name} was staged but not written")
        backup = f"{self.directory}/.backup-{uuid.uuid4().hex}"
        self.disk.make(backup)
        done: list[tuple[str, str]] = []

        def move(source: str, target: str) -> None:
            self.disk.move(source, target)
            done.append((source, target))

        try:
            for name in [*self.staged, *self.stale]:
                if self.disk.exists(f"{self.directory}/{name}"):
                    move(f"{self.directory}/{name}", f"{backup}/{name}")
            for name in self.staged:
                move(f"{self.staging}/{name}", f"{self.directory}/{name}")
        except BaseException:
            for source, target in reversed(done):
                self.disk.move(target, source)
            raise
        finally:
            self.disk.remove(backup)
        self.disk.settle(self.directory)


def write_atomically(path: str, text: str) -> None:
    """One small file, whole or not at all."""
    with AtomicOutputs(os.path.dirname(os.path.abspath(path))) as out:
        with open(out.stage(os.path.basename(path)), "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        out.publish()
