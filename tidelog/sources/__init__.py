"""Readers. Each returns a DataFrame and starts no job."""
