"""Operators for preparing training corpora, each a DataFrame in, DataFrame out function."""
