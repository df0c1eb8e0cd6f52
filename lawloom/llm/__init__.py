"""Operators for preparing language-model training data. Nothing else in lawloom imports them."""
