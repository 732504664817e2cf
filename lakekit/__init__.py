"""Lakehouse analytics operators as plain DataFrame functions."""
