from .change_feed import apply_change_feed, stream_raw_changes

__all__ = ["apply_change_feed", "stream_raw_changes"]
