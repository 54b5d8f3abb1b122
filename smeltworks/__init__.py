"""Medallion analytics on Spark DataFrames: bronze ingestion, silver cleaning, gold KPIs, idempotent loads."""
