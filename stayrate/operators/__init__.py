"""Relational, feature, model and decision operators: DataFrame in, DataFrame out."""
