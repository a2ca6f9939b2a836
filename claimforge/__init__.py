"""Insolvency analytics on Spark: filings, creditors, claims, documents."""
