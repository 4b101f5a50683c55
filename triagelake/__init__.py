"""Spark jobs for analysing and triaging customer-support conversations."""
