"""Sources, sinks and the collector registry."""
