"""Readers and writers for feeds, events, reports and graph versions."""
