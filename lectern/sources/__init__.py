"""sources of the learning-analytics engine."""
