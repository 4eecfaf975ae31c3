"""Operators: DataFrame -> DataFrame building blocks of the pipeline."""
