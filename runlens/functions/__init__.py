"""Column builders.  All of them are plain Catalyst expressions."""

from runlens.functions.cells import cell_text, html_escape, html_header, html_row
from runlens.functions.stages import (
    bar_label,
    call_site,
    done_pct,
    ongoing,
    ongoing_pct,
    stage_action,
    stage_title_html,
    text_label,
)
from runlens.functions.text import (
    any_prefix,
    decode_field,
    encode_data,
    encode_open,
    every,
    is_shippable_jar,
    leading_text,
    mask_home,
    mask_home_prefix,
    split_lines,
    with_prefix,
)

__all__ = [
    "any_prefix",
    "bar_label",
    "call_site",
    "cell_text",
    "decode_field",
    "done_pct",
    "encode_data",
    "encode_open",
    "every",
    "html_escape",
    "html_header",
    "html_row",
    "is_shippable_jar",
    "leading_text",
    "mask_home",
    "mask_home_prefix",
    "ongoing",
    "ongoing_pct",
    "split_lines",
    "stage_action",
    "stage_title_html",
    "text_label",
    "with_prefix",
]
