"""Registered queries."""

from docket.plans import identifiers, pages, records, registers, sources, stream  # noqa: F401
