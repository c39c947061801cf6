"""Medallion analytics for product reviews, written as Spark DataFrame transformations."""
