"""Operators for training data: ranking, survivorship, tokenizing, mixing and splitting. Nothing outside this package imports it."""
