"""Job option texts."""

from __future__ import annotations

import re

from relayframe.functions.times import duration_micros

# Powers of 1024 behind size suffixes.
_SIZE_POWERS = {"B": 0, "K": 1, "M": 2, "G": 3, "T": 4, "P": 5, "E": 6}


def size_bytes(text: str) -> int:
    """``10GB``, ``512K``, ``1.5MiB`` in bytes; units count in 1024s."""
    found = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([BKMGTPE])(?:I?B)?\s*", text.upper())
    if not found or float(found[1]) <= 0:
        raise ValueError(f"invalid size: {text!r}")
    return int(float(found[1]) * 1024 ** _SIZE_POWERS[found[2]])


def duration_millis(text: str) -> int:
    return duration_micros(text) // 1000


def topic_settings(
    retention: str = "168h",
    part_retention_size: str = "10GB",
    cleanup_policy: str = "delete",
    compression_type: str = "producer",
) -> dict[str, str]:
    """Settings for whoever creates the topics."""
    return {
        "compression.type": compression_type,
        "cleanup.policy": cleanup_policy,
        "retention.ms": str(duration_millis(retention)),
        "retention.bytes": str(size_bytes(part_retention_size)),
    }
