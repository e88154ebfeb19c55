"""Operators for preparing text for training language models."""
