"""Input tables: declared schemas, readers and the bindings to the supplied tables."""
