from tiffin.sources.messages import (  # noqa: F401
    kafka_batch,
    kafka_stream,
    message_files,
    message_files_stream,
)
from tiffin.sources.tables import TableLoadError, read_table  # noqa: F401
