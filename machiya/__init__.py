"""Machiya: listing-market analytics expressed as Spark DataFrame operators."""
