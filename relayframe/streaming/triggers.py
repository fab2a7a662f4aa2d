"""Micro-batch timing."""

from __future__ import annotations

from relayframe.functions.options import duration_millis


def every(timeout: str | None) -> dict[str, object]:
    """Trigger arguments: one batch per timeout, or everything there is and stop for None."""
    if timeout is None:
        return {"availableNow": True}
    return {"processingTime": f"{duration_millis(timeout)} milliseconds"}
