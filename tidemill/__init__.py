"""Declarative dataset pipelines on Spark."""
