"""Readers, sinks, schema checks and saved state."""
