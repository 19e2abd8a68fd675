"""Operators for training-data preparation over gazette acts and documents."""
