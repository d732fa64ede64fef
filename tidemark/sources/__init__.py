"""Inputs as DataFrames: catalog metadata, script folders, exported snapshots."""
