"""The reports: tables in, one DataFrame out."""
