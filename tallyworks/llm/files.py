"""Files of own formats that tasks write to and read from the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyarrow import fs


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path)


def write_file(folder: str, name: str, attempt: int, write: Callable) -> str:
    """Write a file under a name of this attempt and move it to its own when it is complete.

    Attempts of one task write the same, so whichever moves last leaves a whole file.
    """
    system, base = filesystem(folder)
    system.create_dir(base, recursive=True)
    draft, path = f"{base}/_{attempt}-{name}", f"{base}/{name}"
    with system.open_output_stream(draft, compression=None) as out:
        write(out)
    try:
        system.move(draft, path)
    except OSError:  # some stores don't move onto a file
        system.delete_file(path)
        system.move(draft, path)
    return f"{folder}/{name}"


def finished_files(folder: str) -> list[tuple[str, int]]:
    """Paths and sizes of the complete files of a folder, by name, or of a single file; none if there is no folder."""
    system, base = filesystem(folder)
    if (alone := system.get_file_info(base)).is_file:
        return [(folder, alone.size)]
    found = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return sorted((f"{folder}/{f.base_name}", f.size) for f in found if f.is_file and not f.base_name.startswith(("_", ".")))
