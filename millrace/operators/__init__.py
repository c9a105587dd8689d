"""Distributed operators shared by the jobs."""
