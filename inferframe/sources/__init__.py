from inferframe.sources.tables import TABLES, load_table  # noqa: F401
from inferframe.sources.readers import (  # noqa: F401
    md5_of_pieces, read_conversations, read_items, read_media, read_media_pieces, read_responses,
)
from inferframe.sources.sinks import write_outcomes, write_requests  # noqa: F401
from inferframe.sources.streams import stream_chunks, stream_task_events  # noqa: F401
