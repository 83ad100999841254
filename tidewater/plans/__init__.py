"""Warehouse jobs: silver transforms, gold models, analytics, quality suite."""
