"""Readers, catalog selection and sinks."""
