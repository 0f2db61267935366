"""Scalar functions as Catalyst expressions."""

from .cnpj import cnpj_is_valid  # noqa: F401
from .text import (  # noqa: F401
    iso_date_or_null, normalize_header,
    numeric_text_guard, parse_date, parse_locale_decimal, round_half_up_ratio,
    text_to_decimal, text_to_int, text_to_long,
)
from .urls import decode_entities, extract_hrefs, file_stem, resolve_url, url_file_name  # noqa: F401
