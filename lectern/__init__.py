"""Learning-analytics datasets and corpus operators as plain PySpark DataFrame functions."""
