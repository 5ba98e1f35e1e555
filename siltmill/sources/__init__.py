"""Reading and writing records, URL lists and settings."""
