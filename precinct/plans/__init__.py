"""Jobs: operators wired to sources and sinks."""
