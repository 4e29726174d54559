"""Composed runs: topic discovery, analysis per topic, report tables."""
