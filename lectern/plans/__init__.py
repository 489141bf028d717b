"""plans of the learning-analytics engine."""
