"""Column functions: text codecs, tag paths and array vectors."""

from topicloom.functions.text import (
    DEFAULT_PATTERN,
    format_weighted,
    join_ids,
    join_tokens,
    letter_runs,
    parse_tokens,
    parse_weighted,
    split_ids,
    split_java,
    string_to_vec,
    tag_prefixes,
    to_half_width,
    to_simplified,
    vec_to_string,
)
from topicloom.functions.vectors import (
    cosine,
    sparse_dot,
    sparse_to_dense,
    truncate6,
    vec_add,
    vec_axpy,
    vec_dot,
    vec_norm,
    vec_normalize,
    vec_scale,
    vec_sum,
)

__all__ = [
    "DEFAULT_PATTERN",
    "cosine",
    "format_weighted",
    "join_ids",
    "join_tokens",
    "letter_runs",
    "parse_tokens",
    "parse_weighted",
    "sparse_dot",
    "sparse_to_dense",
    "split_ids",
    "split_java",
    "string_to_vec",
    "tag_prefixes",
    "to_half_width",
    "to_simplified",
    "truncate6",
    "vec_add",
    "vec_axpy",
    "vec_dot",
    "vec_norm",
    "vec_normalize",
    "vec_scale",
    "vec_sum",
    "vec_to_string",
]
