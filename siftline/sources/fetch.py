"""Files from elsewhere, checked by digest before they are put in place."""

from __future__ import annotations

import hashlib
import os
import re
import time
import urllib.request
from collections.abc import Callable
from pathlib import Path


class ChecksumError(ValueError):
    """A file's digest is not the stated one."""


def sha256(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _over_http(url: str) -> bytes:
    with urllib.request.urlopen(url, timeout=60) as response:  # noqa: S310
        return response.read()


def without_properties(sdf: bytes, names: list[str]) -> bytes:
    """An SDF text without the named property blocks, which change between downloads."""
    text = sdf.decode("utf-8")
    for name in names:
        text = re.sub(rf">\s+<{re.escape(name)}>[^\n]*\n(?:[^\n]+\n)*\n", "", text)
    return text.encode("utf-8")


def fetch(url: str, path: str, digest: str | None = None, read: Callable[[str], bytes] = _over_http, clean: Callable[[bytes], bytes] = bytes, tries: int = 3, pause: float = 1.0) -> str:
    """The file's SHA-256. It is kept if already right, else read (again after a pause that grows), cleaned, checked and
    renamed into place."""
    if digest and os.path.exists(path) and sha256(path) == digest:
        return digest
    for attempt in range(1, tries + 1):
        try:
            data = clean(read(url))
            break
        except OSError:
            if attempt == tries:
                raise
            time.sleep(pause * attempt)
    found = hashlib.sha256(data).hexdigest()
    if digest and found != digest:
        raise ChecksumError(f"{url}: {found} is not {digest}")
    partial = Path(f"{path}.partial")
    partial.parent.mkdir(parents=True, exist_ok=True)
    partial.write_bytes(data)
    os.replace(partial, path)
    return found


def verify(expected: dict[str, str], folder: str) -> dict[str, bool]:
    """For each file name: is it there with the stated digest?"""
    return {name: os.path.exists(p := os.path.join(folder, name)) and sha256(p) == digest for name, digest in expected.items()}
