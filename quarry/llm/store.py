"""Arrays in the shared folder: tasks write them shard by shard, workers map
them into memory. A shard holds the keys whose top bits are its number, sorted.

Files are written under a name of their own and then renamed, so a task that
runs twice leaves one whole file. In a file system that can't be mapped, a
worker copies a shard to an unnamed temporary file when it first needs it.

The folder comes from ``common.shared_dir``, which names its file system, so no
path is taken for a local one by mistake. Writers report the shards they wrote;
a reader that knows them raises if one is not there, as on a folder that is not
shared after all, instead of taking it for empty.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np


def local(uri: str) -> str | None:
    """The path behind ``uri`` where it is mounted, else None."""
    if uri.startswith("file:"):
        return urlparse(uri).path
    return uri if "://" not in uri else None


def save(folder: str, name: str, values: np.ndarray) -> None:
    path = local(folder)
    if path is None:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        held = io.BytesIO()
        np.save(held, values)
        with files.open_output_stream(f"{base}/{name}.npy") as out:
            out.write(held.getvalue())
        return
    os.makedirs(path, exist_ok=True)
    part = os.path.join(path, f".{name}-{uuid.uuid4().hex}.npy")
    with open(part, "wb") as out:
        np.save(out, values)
    os.replace(part, os.path.join(path, f"{name}.npy"))


def load(folder: str, name: str) -> np.ndarray | None:
    """The array, memory-mapped; None if it was never written."""
    path = local(folder)
    if path is not None:
        file = os.path.join(path, f"{name}.npy")
        return np.load(file, mmap_mode="r") if os.path.exists(file) else None
    from pyarrow import fs

    files, base = fs.FileSystem.from_uri(folder)
    if files.get_file_info(f"{base}/{name}.npy").type == fs.FileType.NotFound:
        return None
    with tempfile.NamedTemporaryFile(suffix=".npy") as copy, files.open_input_stream(f"{base}/{name}.npy") as src:
        while piece := src.read(1 << 24):
            copy.write(piece)
        copy.flush()
        return np.load(copy.name, mmap_mode="r")


class Shards:
    """Reader of keys (uint64) with values. ``name`` has one sorted key array
    per shard, ``columns`` the value arrays beside it."""

    def __init__(self, folder: str, bits: int, name: str, columns: tuple[str, ...], there: frozenset[int]):
        self.folder, self.bits, self.name, self.columns, self.there = folder, bits, name, columns, there
        self.open: dict[int, list] = {}

    def _shard(self, i: int) -> list:
        if i not in self.there:
            return [None] * (1 + len(self.columns))
        if i not in self.open:
            found = [load(self.folder, f"{c}-{i:06d}") for c in (self.name, *self.columns)]
            if any(x is None for x in found):
                raise FileNotFoundError(
                    f"shard {i} of {self.name!r} was written to {self.folder}, but is not there: "
                    "is spark.checkpoint.dir shared by all executors?"
                )
            self.open[i] = found
        return self.open[i]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """For sorted keys: which are there, and their values (0 if not)."""
        hit, out = np.zeros(len(keys), bool), [None] * len(self.columns)
        bounds = np.searchsorted(keys >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64))
        for i in range(1 << self.bits):
            a, b = bounds[i], bounds[i + 1]
            if a == b:
                continue
            stored, *values = self._shard(i)
            if stored is None or not len(stored):
                continue
            at = np.minimum(np.searchsorted(stored, keys[a:b]), len(stored) - 1)
            hit[a:b] = stored[at] == keys[a:b]
            for j, v in enumerate(values):
                if out[j] is None:
                    out[j] = np.zeros(len(keys), v.dtype)
                out[j][a:b] = np.where(hit[a:b], v[at], 0)
        return hit, [np.zeros(len(keys), np.int64) if v is None else v for v in out]


def written_shards(rows) -> frozenset[int]:
    """The shards that tasks reported (a table with ``shard``): at most one
    number per shard."""
    return frozenset(r["shard"] for r in rows.select("shard").distinct().collect())


def shard_bits(width: int) -> int:
    """Bits that give at least ``width`` shards."""
    return max(1, (max(2, width) - 1).bit_length())
