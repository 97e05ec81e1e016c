"""Readers, sinks and the views that carry the test tables into the shapes the operators expect."""
