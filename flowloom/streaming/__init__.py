"""streaming of the flow engine."""
