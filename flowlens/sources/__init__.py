from flowlens.sources.tables import publish, read_published, read_table

__all__ = ["publish", "read_published", "read_table"]
