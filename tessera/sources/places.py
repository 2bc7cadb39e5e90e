"""Where a path leads: the file system and the path in it that tasks open themselves."""

from __future__ import annotations

from urllib.parse import quote

import pyarrow.fs as pafs

#: What stays as it is in a URI; percent signs too, so that encoded paths are taken as well.
PLAIN = "%/:[]@!$&'()*+,;=~"


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it of a URI or an absolute local path. Spark's listings give paths with blanks and other characters that
    no URI holds: these are encoded first. A percent sign is taken for the beginning of an encoded character."""
    if path.startswith("file:"):
        return pafs.FileSystem.from_uri(quote(path, safe=PLAIN))
    if "://" in path:
        return pafs.FileSystem.from_uri(quote(path, safe=PLAIN + "?"))  # options of the file system
    return pafs.LocalFileSystem(), path
