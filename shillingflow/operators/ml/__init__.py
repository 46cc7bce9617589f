"""Fraud features, isolation forest, supervised models and their vote."""
