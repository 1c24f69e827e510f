"""Checkpointed streaming jobs and online learners."""
