"""Readers and writers of feeds, timetables and published files."""
