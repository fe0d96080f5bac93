"""Readers: CSV files, zipped exports, tracking logs, course archives, relational sources."""
