from strata.functions.columns import (
    DEFAULT_DATE_FORMATS,
    ascending,
    HASH_SEPARATOR,
    NULL_TOKEN,
    blank_to_null,
    clean_text,
    first_element,
    hash_text,
    in_domain,
    keyed_value,
    md5_of,
    month_end_of_index,
    month_index,
    no_digit,
    not_in_domain,
    parse_date,
    parse_timestamp,
    safe_int,
    text_to_bool,
    upper_text,
)

__all__ = [
    "DEFAULT_DATE_FORMATS", "ascending", "HASH_SEPARATOR", "NULL_TOKEN", "blank_to_null", "clean_text",
    "first_element", "hash_text", "in_domain", "keyed_value", "md5_of", "month_end_of_index",
    "month_index", "no_digit", "not_in_domain", "parse_date", "parse_timestamp", "safe_int",
    "text_to_bool", "upper_text",
]
