"""Profiling, modelling and batch scoring of tabular data with a binary target, on PySpark."""

from tabloom.roles import Roles, Settings

__all__ = ["Roles", "Settings"]
