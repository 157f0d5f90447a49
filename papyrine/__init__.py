"""Papyrine: a PySpark-native pipeline for scientific and patent records."""
