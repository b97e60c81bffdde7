"""Composite jobs: copy plans, validation, redaction, index, verify."""
