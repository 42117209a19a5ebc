"""Whole jobs: staging, marts, linked data, features, models, reports."""
