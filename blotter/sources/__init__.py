"""Readers and writers: typed CSV loaders, test-table views, marts, sinks."""
