"""Importing this module registers every query."""
from checks import fleet, jobs, marts, quality, storage  # noqa: F401
