from ledgerline.functions.base58 import b58encode, base58, encode_many
from ledgerline.functions.scalars import (
    authority_level,
    bucket_start,
    channel_subject,
    epoch_seconds,
    flag_u8,
    key_from_long,
    narrow_u32,
    start_slot,
    strip_repeated_suffix,
)

__all__ = [
    "authority_level", "b58encode", "base58", "bucket_start", "channel_subject",
    "encode_many", "epoch_seconds", "flag_u8", "key_from_long", "narrow_u32",
    "start_slot", "strip_repeated_suffix",
]
