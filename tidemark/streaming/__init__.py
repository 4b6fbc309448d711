from tidemark.streaming.files import incremental_stream

__all__ = ["incremental_stream"]
