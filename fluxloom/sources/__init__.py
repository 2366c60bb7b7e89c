"""Reading and writing of measurement tables, histories and stages."""
