"""Input tables: declared schemas and loaders."""
