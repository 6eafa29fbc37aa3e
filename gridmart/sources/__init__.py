"""Readers, generators and sinks."""
