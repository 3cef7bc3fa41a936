"""Whole jobs: staging, the catalogue build, and the derived inputs of the registered queries."""
