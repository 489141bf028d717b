"""streaming of the learning-analytics engine."""
