"""Arrival-record analytics on Spark: cleaning, demography, star schema."""
