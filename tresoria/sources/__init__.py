"""Sources (workbooks, CSV, tables, file discovery) and sinks (tables)."""
