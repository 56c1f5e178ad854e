"""Sources, sinks and the stand-in input tables."""
