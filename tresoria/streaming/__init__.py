"""Incremental (streaming) ingestion of workbooks dropped in a folder."""
