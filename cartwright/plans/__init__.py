"""Dataflows: preparation, segments, rules, popularity, recommendation, evaluation."""
