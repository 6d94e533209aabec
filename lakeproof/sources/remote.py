"""Open files from inside tasks, by the addresses that Spark's file index reports."""

from __future__ import annotations

import re

import pyarrow.fs as pafs


def resolve(address: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and path of an address such as ``file:/x``, ``hdfs://h/x`` or ``s3://b/x``."""
    local = re.sub(r"^file:/+", "/", address)
    return pafs.FileSystem.from_uri(local)
