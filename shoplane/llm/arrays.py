"""Arrays written by tasks to the shared folder and memory-mapped by workers.

A file holds several arrays one after the other. Its description (a short JSON text) travels through
Spark. Every attempt of a task writes a file of its own, and only descriptions returned by a successful
attempt are used, so retries and lost executors leave nothing half-written in use. A folder in a store
that has no local path is read through ``pyarrow.fs`` into an unlinked temporary file and mapped there.
"""

from __future__ import annotations

import json
import mmap
import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import numpy as np


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def save(folder: str, name: str, **arrays: np.ndarray) -> str:
    """Write the arrays to a new file in ``folder``; return its description."""
    uri = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}.bin"
    fields, at = {}, 0
    for key, a in arrays.items():
        fields[key] = [a.dtype.str, at, len(a)]
        at += -(-a.nbytes // 8) * 8
    if (path := _local(uri)) is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        out = open(path, "wb")
    else:
        from pyarrow import fs
        store, path = fs.FileSystem.from_uri(uri)
        out = store.open_output_stream(path)
    with out:
        for a in arrays.values():
            out.write(np.ascontiguousarray(a).tobytes())
            out.write(bytes(-a.nbytes % 8))
    return json.dumps({"uri": uri, "size": at, "fields": fields})


def load(description: str) -> dict[str, np.ndarray]:
    """The arrays of a description, memory-mapped read-only."""
    d = json.loads(description)
    if not d["size"]:
        return {k: np.zeros(0, np.dtype(t)) for k, (t, _, _) in d["fields"].items()}
    if (path := _local(d["uri"])) is not None:
        with open(path, "rb") as f:
            view = mmap.mmap(f.fileno(), d["size"], access=mmap.ACCESS_READ)
    else:
        import shutil
        from pyarrow import fs
        store, path = fs.FileSystem.from_uri(d["uri"])
        with tempfile.TemporaryFile() as f:
            with store.open_input_stream(path) as source:
                shutil.copyfileobj(source, f)
            f.flush()
            view = mmap.mmap(f.fileno(), d["size"], access=mmap.ACCESS_READ)
    return {k: np.frombuffer(view, np.dtype(t), n, at) for k, (t, at, n) in d["fields"].items()}
