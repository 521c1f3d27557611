"""Stages of the lake: landing, validation, star schema, checks, risk and drift."""
