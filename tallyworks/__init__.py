"""Spark-native analytical operators for stock, ledger, invoice and IT-cost data."""
