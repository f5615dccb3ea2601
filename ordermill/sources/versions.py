"""Small documents kept in versions: a reader sees one whole version, a writer puts the next one at once.

Each version is a JSON file with a number of its own, written under another name first and then renamed.
The version before the latest stays, for readers that have just opened it.
"""

from __future__ import annotations

import contextlib
import json

from pyarrow import fs

from ordermill.sources.listing import open_filesystem


def _files(folder: str) -> tuple[fs.FileSystem, str, list[str]]:
    filesystem, base = open_filesystem(folder)
    infos = filesystem.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return filesystem, base, sorted(i.path for i in infos if i.path.endswith(".json"))


def latest(folder: str):
    """The newest document, None without one."""
    filesystem, _, files = _files(folder)
    if not files:
        return None
    with filesystem.open_input_stream(files[-1]) as file:
        return json.loads(file.read())


def put(folder: str, document) -> None:
    filesystem, base, files = _files(folder)
    number = int(files[-1].rpartition("/")[2].removesuffix(".json")) + 1 if files else 1
    filesystem.create_dir(base, recursive=True)
    with filesystem.open_output_stream(f"{base}/{number:012d}.part") as file:
        file.write(json.dumps(document).encode())
    filesystem.move(f"{base}/{number:012d}.part", f"{base}/{number:012d}.json")
    for name in files[:-1]:
        with contextlib.suppress(FileNotFoundError):
            filesystem.delete_file(name)
