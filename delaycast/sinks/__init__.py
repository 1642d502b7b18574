"""Writers for CSV, tables, topics and scored documents."""
