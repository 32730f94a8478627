"""Logs, schemas and generated orders."""
