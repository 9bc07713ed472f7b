"""Names that keep the rows of several streams in one table apart."""

from __future__ import annotations

import hashlib


def stream_name(checkpoint: str, name: str | None = None) -> str:
    """The given name, or one that follows from the checkpoint.

    Batch ids start at 0 in every checkpoint, so a stream's partitions carry this name too:
    two streams, or a new checkpoint, never overwrite each other's rows. Given names must
    differ between the streams of one root.
    """
    return name or "s" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
