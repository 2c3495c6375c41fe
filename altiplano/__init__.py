"""Altiplano: stereo elevation analytics as Spark DataFrame operators."""
