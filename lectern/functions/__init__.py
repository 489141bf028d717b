"""functions of the learning-analytics engine."""
