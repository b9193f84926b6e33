"""Composed jobs: pipeline stages, registered queries and their SQL oracle."""
