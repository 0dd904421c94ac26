"""Feature, alignment, splitting and evaluation operators for gridded and station data on Spark."""
