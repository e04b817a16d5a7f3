"""Operators that prepare text for training language models, one module each."""
