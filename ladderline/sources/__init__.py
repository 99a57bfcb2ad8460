"""Scans: text reports and spreadsheet reports."""
