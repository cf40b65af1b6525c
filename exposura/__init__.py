"""Exposure analytics on Spark: detect, classify, mask, dedup, count, flag, score."""
