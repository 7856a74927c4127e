"""Incremental refresh with Structured Streaming."""

from marquee.streaming.refresh import (
    current_catalogue, merge_batch, prune_store, read_manifest, refresh_catalogue,
)

__all__ = ["current_catalogue", "merge_batch", "prune_store", "read_manifest", "refresh_catalogue"]
