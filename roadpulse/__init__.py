"""roadpulse: micro-batch observation and incident analytics on Spark."""

__version__ = "0.1.0"
