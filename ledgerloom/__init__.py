"""DataFrame operators for landing, cleaning and modelling multi-source commercial data on Spark."""

__version__ = "0.1.0"
