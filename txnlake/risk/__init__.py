"""Behavioural features, isolation forest, calibration, reasons, drift and promotion gates."""
