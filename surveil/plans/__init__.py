"""Dataflows made of the operators: risk, evaluation, reports."""
