"""Corpuscle: transcript and annotation analytics as Spark plans."""
