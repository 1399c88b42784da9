"""Operators that prepare text for training, and their queries."""
