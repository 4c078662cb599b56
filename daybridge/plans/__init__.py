"""Jobs put together from sources, operators and sinks."""
