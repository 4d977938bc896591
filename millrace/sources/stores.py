"""Files of a store by path, inside a task: local and shared folders, and what pyarrow's file systems reach."""

from __future__ import annotations

from pyarrow.fs import FileSelector, FileSystem, FileType


def store(path: str) -> tuple[FileSystem, str]:
    """The file system and the path inside it."""
    bare = path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:")
    return FileSystem.from_uri(bare) if "://" in bare or bare.startswith("/") else FileSystem.from_uri(f"/{bare}")


def opened(path: str):
    fs, inner = store(path)
    return fs.open_input_file(inner)


def exists(path: str) -> bool:
    fs, inner = store(path)
    return fs.get_file_info(inner).type != FileType.NotFound


def found(path: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files below a folder but those whose names start with _ or a dot, in order."""
    fs, inner = store(path)
    here = fs.get_file_info(inner)
    if here.type == FileType.File:
        return [(path, here.size)]
    files = fs.get_file_info(FileSelector(inner, recursive=True))
    root = path.rstrip("/")
    names = [(f.path[len(inner.rstrip("/")) + 1 :], f.size) for f in files if f.type == FileType.File]
    return sorted((f"{root}/{n}", size) for n, size in names if not any(part[0] in "_." for part in n.split("/")))
