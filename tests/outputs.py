"""Reading what the plans write."""

import gzip


def content(path) -> str:
    """A document, or the part files of a table one after another."""
    parts = sorted(path.glob("part-*")) if path.is_dir() else [path]
    data = [p.read_bytes() for p in parts]
    return b"".join(gzip.decompress(d) if d[:2] == b"\x1f\x8b" else d for d in data).decode()
