"""Reusable operators: latest-per-key, rolling windows, candle flags, trade tape,
session buckets and key/null audits."""
