"""Readers and writers: pinned CSV and page snapshots, wiki exports, Turtle, manifests, graph snapshots."""
