"""Files that tasks write to a shared folder: temporary name, hash, rename to a name of the content."""

from __future__ import annotations

import hashlib
import uuid

from pyarrow import fs as pafs
from pyspark.sql import SparkSession

from tastemap.session import checkpoint_dir


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class SealedFile:
    """Every attempt of a task writes a file of its own; ``seal`` renames it to
    ``<prefix>-<hash><suffix>``, the same name for the same bytes."""

    def __init__(self, folder: str):
        self.fs, self.root = open_fs(folder)
        self.temp = f"{self.root}/_temporary/{uuid.uuid4().hex}"
        self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
        self.out, self.sha, self.size = self.fs.open_output_stream(self.temp, compression=None), hashlib.sha256(), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def seal(self, prefix: str, suffix: str) -> tuple[str, int, str]:
        """(name, bytes, sha256)"""
        self.out.close()
        digest = self.sha.hexdigest()
        name = f"{prefix}-{digest[:16]}{suffix}"
        self.fs.move(self.temp, f"{self.root}/{name}")
        return name, self.size, digest


class Checked:
    """Reads a stream and keeps the size and hash of what was read."""

    def __init__(self, raw):
        self.raw, self.sha, self.size = raw, hashlib.sha256(), 0

    def read(self, n: int) -> bytes:
        b = self.raw.read(n)
        self.sha.update(b)
        self.size += len(b)
        return b
