"""Scoring of tables that keep arriving."""
