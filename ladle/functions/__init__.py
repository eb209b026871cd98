from ladle.functions.keys import content_hash, hash_key
from ladle.functions.scalars import day_serial_to_date, epoch_ms_to_timestamp, implied_decimal

__all__ = ["content_hash", "day_serial_to_date", "epoch_ms_to_timestamp", "hash_key", "implied_decimal"]
