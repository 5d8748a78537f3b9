"""Tables and files between steps, in the folder that a cluster's executors share."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from tariff_engine.shared import shared_folder, written

__all__ = ["mounted", "shared_folder", "written"]


def mounted(folder: str) -> str:
    """The path under which tasks open the folder's files; it has to be mounted on every machine."""
    parts = urlparse(folder)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted folder, not {parts.scheme}://")
    return unquote(parts.path)
