"""Readers and writers: vocabulary files, concept maps, source tables, targets."""
