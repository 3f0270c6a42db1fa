"""Data quality and price analytics for staged market data, on Spark DataFrames."""
