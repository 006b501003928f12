"""Small files in a folder that driver and executors share, from Python on either side."""

from __future__ import annotations

import re

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder; Hadoop's short form of local paths is understood."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


class Marker:
    """A file that is there or not: any task may raise it, all see it."""

    def __init__(self, uri: str):
        self.uri = uri

    def _at(self) -> tuple[fs.FileSystem, str]:
        return open_folder(self.uri)

    def up(self) -> bool:
        store, path = self._at()
        return store.get_file_info(path).type != fs.FileType.NotFound

    def put(self) -> None:
        store, path = self._at()
        store.create_dir(path.rpartition("/")[0])
        store.open_output_stream(path).close()

    def clear(self) -> None:
        store, path = self._at()
        if self.up():
            store.delete_file(path)
