"""functions of the flow engine."""
