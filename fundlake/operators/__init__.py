"""Relational building blocks: plain functions from DataFrame to DataFrame."""
