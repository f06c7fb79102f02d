"""Releases are whole snapshots, so nothing here needs a stream. ``releases`` feeds snapshots that arrive as a stream through the version operator."""
