"""Detectors, windows, aggregates and reports over series frames."""
