"""Medallion tables on Spark: land, clean, hold back conflicts, model, prove and measure."""
