"""Readers: landing files, staging, and the adapter over the events table."""
