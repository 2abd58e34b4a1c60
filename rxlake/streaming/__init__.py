from rxlake.streaming.landing import land_to_bronze, landed_pages_stream

__all__ = ["land_to_bronze", "landed_pages_stream"]
