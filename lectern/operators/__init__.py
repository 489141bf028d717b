"""operators of the learning-analytics engine."""
