"""Readers: raw logs, text inputs, rule and lookup tables, stored reports."""
