"""Readers, schema contracts and fitted-model loading."""
