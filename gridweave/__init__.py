"""Grid, point and catalogue analytics on Spark."""
