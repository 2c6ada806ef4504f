"""Table and file sources, sinks, and the shared staging folder."""
