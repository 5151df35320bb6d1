"""Sinks: text files by probe and period."""
