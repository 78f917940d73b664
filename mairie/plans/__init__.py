"""Pipelines composed from the operators: silver, gold, models, questions."""
