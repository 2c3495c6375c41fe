"""Numerical kernels on numpy arrays, and their use on Arrow batches and tile groups."""
