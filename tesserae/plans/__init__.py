"""Registered queries: each binds an operator to tables of a scale folder."""

from tesserae.plans import aligned, annotation, counting, files, quality, reads, signatures, spatial, trimming  # noqa: F401
