"""Loan-origination analytics on Spark: data quality, star schema and KPIs as DataFrame operators."""
