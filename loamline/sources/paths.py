"""Files of a shared file system, or of a store that Arrow's file systems know, from Python."""

from __future__ import annotations

import os
import re


def remote(path: str) -> bool:
    return "://" in path and not path.startswith("file:")


def local(path: str) -> str:
    return re.sub(r"^file:/+", "/", path)


def opened(path: str):
    """A seekable file: local ones by the system itself, others by Arrow's file systems, loaded only then."""
    if not remote(path):
        return open(local(path), "rb")  # noqa: SIM115
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def known(path: str) -> bool:
    """Whether files there can be opened and written."""
    if not remote(path):
        return True
    import pyarrow as pa
    from pyarrow import fs

    try:
        fs.FileSystem.from_uri(path)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def exists(path: str) -> bool:
    if not remote(path):
        return os.path.exists(local(path))
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.get_file_info(inner).type != fs.FileType.NotFound


def written(path: str, data: bytes) -> None:
    """A new file with its folders; whoever names it does so after it is whole."""
    if not remote(path):
        os.makedirs(os.path.dirname(local(path)), exist_ok=True)
        with open(local(path), "wb") as f:
            f.write(data)
        return
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(inner) as f:
        f.write(data)


def removed(path: str) -> None:
    """A file that may be gone already."""
    try:
        if not remote(path):
            os.unlink(local(path))
            return
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        system.delete_file(inner)
    except FileNotFoundError:
        pass
