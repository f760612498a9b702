"""Readers, sinks, JSON artefacts, the run table and generated rows."""
