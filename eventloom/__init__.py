"""Spark operators over events, observations, manifests and text corpora."""
