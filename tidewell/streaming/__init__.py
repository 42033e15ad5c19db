from .landed import drop_repeats, stream_sync

__all__ = ["drop_repeats", "stream_sync"]
