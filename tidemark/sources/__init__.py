"""Readers that turn files, topics and pages into DataFrames."""
