"""Files in whatever file system their path names, as Python tasks open them."""

from __future__ import annotations

from pyarrow import fs


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    return fs.FileSystem.from_uri(path)


def files_under(path: str, suffix: str = "") -> list[str]:
    """Addresses of a file, or of the files below a folder, in order."""
    system, base = file_system(path)
    info = system.get_file_info(base)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
    head = path[: len(path) - len(base)] if path.endswith(base) else ""
    names = sorted(f.path for f in found if f.type == fs.FileType.File and f.path.endswith(suffix) and not f.base_name.startswith(("_", ".")))
    return [head + n for n in names]
