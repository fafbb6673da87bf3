"""Layers, reports and the pipeline, composed from the operators."""
