"""The composite reports."""
