from plumbline.streaming.microbatch import validate_stream

__all__ = ["validate_stream"]
