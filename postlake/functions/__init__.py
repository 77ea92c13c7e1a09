"""Scalar Column expressions (all JVM-side, codegen-friendly)."""

from .parse import derive_date, hashtags_str, parse_hashtags, parse_ts, to_bool, to_long
from .probs import argmax, confidence, label_id, label_name, log_softmax_at, softmax
from .text import (
    clean_location,
    clean_text,
    is_blank,
    model_text,
    normalize_ws,
    py_strip,
    strip_mentions,
    strip_urls,
    truncate_tokens,
)
from .uri import parse_s3_uri, run_key, run_path, split_s3_uri

__all__ = [
    "argmax",
    "clean_location",
    "clean_text",
    "confidence",
    "derive_date",
    "hashtags_str",
    "is_blank",
    "label_id",
    "label_name",
    "log_softmax_at",
    "model_text",
    "normalize_ws",
    "parse_hashtags",
    "parse_s3_uri",
    "parse_ts",
    "py_strip",
    "run_key",
    "run_path",
    "softmax",
    "split_s3_uri",
    "strip_mentions",
    "strip_urls",
    "to_bool",
    "to_long",
    "truncate_tokens",
]
