"""Files in the shared folder, opened inside tasks by their URI."""

from __future__ import annotations

from pyarrow import fs


def open_uri(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI such as ``file:/shared/x`` or ``hdfs://host/x``."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, data) -> None:
    """Write a whole file so that it appears only when it is complete."""
    system, path = open_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path + ".part", compression=None) as out:
        out.write(data)
    system.move(path + ".part", path)
