"""Relational building blocks shared by the models."""
