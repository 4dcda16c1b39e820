"""Result files and code as one archive."""

from __future__ import annotations

import os
import zipfile

LEFT_OUT = {"__pycache__", ".git", ".venv", ".pytest_cache"}


def package(archive: str, folders: dict[str, str]) -> list[str]:
    """Write a zip of whole folders (path: name in the archive); returns the names of its files, sorted.

    Compiled files, hidden files and the folders of LEFT_OUT stay out. A missing folder is an error. A table that
    was written as a folder of parts goes in part by part.
    """
    names = []
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path, name in sorted(folders.items()):
            if not os.path.isdir(path):
                raise FileNotFoundError(path)
            for root, inner, files in os.walk(path):
                inner[:] = sorted(d for d in inner if d not in LEFT_OUT)
                for f in sorted(files):
                    if not f.startswith(".") and not f.endswith((".pyc", ".pyo")):
                        target = os.path.join(name, os.path.relpath(os.path.join(root, f), path)).replace(os.sep, "/")
                        z.write(os.path.join(root, f), target)
                        names.append(target)
    return sorted(names)
