"""Whole workflows: preparation, model selection, scoring, evaluation, attribution."""
