"""Reading and writing: landed provider items, layer tables, catalog."""
