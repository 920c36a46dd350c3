"""Whole flows composed from operators, and the size checks behind their choices."""
