"""Readers, sinks and content access (manifests, analysis outputs, asset tables, files)."""
