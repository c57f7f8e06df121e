"""Medallion analytics (Bronze -> Silver -> Gold) written as Spark DataFrame functions."""
