"""Readers and writers: saved pages, search hits, documents, snapshots, exports."""
