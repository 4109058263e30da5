"""Transcript and corpus analytics as Spark plans."""
