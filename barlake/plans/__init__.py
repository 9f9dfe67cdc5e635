"""Composite plans: the stage chains the jobs and registered queries run."""
