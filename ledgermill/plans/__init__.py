"""Whole plans: gold metrics, department reports and the pipeline entry points."""
