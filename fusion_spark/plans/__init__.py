"""Stages of the analysis, composed from the operators."""
