"""Inputs, layer schemas and table writing."""
