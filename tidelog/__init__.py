"""tidelog: market-log and order-book analytics on DataFrames."""

__version__ = "0.1.0"
