"""Composed jobs: reports, projections, scoring."""
