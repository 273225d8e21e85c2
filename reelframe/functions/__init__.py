from reelframe.functions.scalar import (
    float_to_long,
    json_names,
    json_text,
    key_bytes,
    key_number,
    nonzero,
    round_1,
    split_quoted,
    title_head,
    to_float,
    to_int,
    unquote_field,
)

__all__ = [
    "float_to_long",
    "json_names",
    "json_text",
    "key_bytes",
    "key_number",
    "nonzero",
    "round_1",
    "split_quoted",
    "title_head",
    "to_float",
    "to_int",
    "unquote_field",
]
