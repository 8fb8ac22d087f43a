"""Scalar expressions used by table recipes."""
