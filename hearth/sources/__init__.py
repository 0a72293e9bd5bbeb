"""Readers and writers: landed pages and images, region dimension, stage tables."""
