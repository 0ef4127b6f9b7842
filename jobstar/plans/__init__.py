"""Stages of the pipeline and the catalog of driver-table queries."""
