from tiffin.sinks.tables import TableStore, stamped  # noqa: F401
