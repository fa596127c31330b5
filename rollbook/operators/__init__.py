"""Operators over warehouse tables: flattening, replacing slices, checks and look-ups."""
