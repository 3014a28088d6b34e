"""Whole tables and reports, composed from the operators."""
