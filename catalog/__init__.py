"""Registered queries and the SQL that each is checked against."""

from __future__ import annotations

from catalog import answering, chunking, cleaning, profiling, retrieval, storage
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "answering", "chunking", "cleaning", "profiling", "retrieval", "storage"]
