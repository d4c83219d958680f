"""martflow: dimensional data marts as Spark DataFrame functions."""
