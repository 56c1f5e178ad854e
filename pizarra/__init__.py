"""pizarra: Spark DataFrame operators and jobs for education analytics."""

__version__ = "0.1.0"
