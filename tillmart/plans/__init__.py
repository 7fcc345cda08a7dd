"""Whole jobs: ingest, datamarts, export, worksheets and run audit."""
