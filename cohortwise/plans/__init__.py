"""Registered queries on the star-schema and event tables, and their SQL counterparts."""
