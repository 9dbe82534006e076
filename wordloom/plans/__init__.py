"""Whole jobs built from the operators: fitting, tuning, evaluating, scoring, logging runs."""
